"""Options of ``normalize``, checked as one value."""

from __future__ import annotations

from dataclasses import dataclass

ID_MODES = ("random", "content")


@dataclass(frozen=True)
class Options:
    enable_enrichment: bool = False
    threshold: float = 0.5
    id_mode: str = "random"

    def __post_init__(self):
        if self.id_mode not in ID_MODES:
            raise ValueError(f"id_mode must be one of {ID_MODES}, not {self.id_mode!r}")
        if not 0.0 <= self.threshold <= 1.0:
            raise ValueError("threshold must lie in [0, 1]")
