"""Pack documents into training sequences (hierarchical multi-length packing)."""

from __future__ import annotations

import bisect
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bugsieve.llm.common import per_worker, release_memory

WINDOW = 2048
#: Context sizes, longest first; all are powers of two, so a full sequence needs no padding.
TIERS = (2048, 1024, 512, 256)
END_ID = 1
#: Tokens of a training step; sequences of one tier form groups of this many tokens.
STEP_TOKENS = 16 * WINDOW
#: Tokens packed together at most (some 4 bytes each); a task packs one such lot after another.
LOT_TOKENS = 2_000_000


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def load_encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizer.json``, special tokens included, on the faster of two
    libraries that give the same ids."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte = _byte_of()
    ranks = {bytes(byte[c] for c in piece): rank for piece, rank in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for piece in special:
        ranks.pop(piece.encode(), None)
    # Fixed value: the split pattern of byte-level vocabularies.
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("pack", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


class _Pool:
    """Pieces (document, start) by length."""

    def __init__(self) -> None:
        self.lengths: list[int] = []
        self.pieces: dict[int, list[tuple[int, int]]] = {}

    def add(self, length: int, piece: tuple[int, int]) -> None:
        if length not in self.pieces:
            bisect.insort(self.lengths, length)
            self.pieces[length] = []
        self.pieces[length].append(piece)

    def take(self, most: int) -> tuple[int, tuple[int, int]] | None:
        """The longest piece of at most that length."""
        at = bisect.bisect_right(self.lengths, most) - 1
        if at < 0:
            return None
        length = self.lengths[at]
        piece = self.pieces[length].pop()
        if not self.pieces[length]:
            del self.pieces[length], self.lengths[at]
        return length, piece


def plan(doc_tokens: list[int], tiers: tuple[int, ...] = TIERS) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences (tier, pieces (document, start, length)) that hold every token once.

    Whole windows of long documents are sequences of their own. What remains goes to the
    shortest tier that holds it. Tiers are packed from the longest: its longest piece opens a
    window, the gap takes the longest pieces of shorter tiers that fit, and one more is cut to
    close it. The tokens left when no piece remains are cut at powers of two.
    """
    top = tiers[0]
    pool = _Pool()
    for doc, n in enumerate(doc_tokens):
        for start in range(0, n - top + 1, top):
            yield top, [(doc, start, top)]
        if n % top:
            pool.add(n % top, (doc, n - n % top))
    rest: list[tuple[int, int, int]] = []
    for tier, below in zip(tiers, (*tiers[1:], 0), strict=True):
        while pool.lengths and pool.lengths[-1] > below:
            gap, window = tier, []
            while gap and (found := pool.take(gap)):
                length, (doc, start) = found
                window.append((doc, start, length))
                gap -= length
            if gap and pool.lengths:
                length, (doc, start) = pool.take(top)
                window.append((doc, start, gap))
                pool.add(length - gap, (doc, start + gap))
                gap = 0
            if gap:
                rest = window
            else:
                yield tier, window
    left = sum(length for *_, length in rest)
    while left:
        size = 1 << (left.bit_length() - 1)
        window, gap = [], size
        while gap:
            doc, start, length = rest.pop(0)
            if length > gap:
                rest.insert(0, (doc, start + gap, length - gap))
                length = gap
            window.append((doc, start, length))
            gap -= length
        left -= size
        yield size, window


def step_groups(tiers: list[int], costs: list[int], step_tokens: int) -> list[int]:
    """A group for each sequence, by tier and cost: as few groups of a tier as ``step_tokens`` allows.

    The sequences of a tier are dealt in order of their cost, back and forth over its groups. So two
    groups of a tier differ by one sequence at most and, where they have as many, by no more cost than
    the dearest and the cheapest sequence do.
    """
    out = [0] * len(tiers)
    first = 0
    for tier in sorted(set(tiers), reverse=True):
        mine = sorted((i for i, t in enumerate(tiers) if t == tier), key=lambda i: -costs[i])
        groups = -(-len(mine) // max(1, step_tokens // tier))
        for place, i in enumerate(mine):
            turn, at = divmod(place, groups)
            out[i] = first + (groups - 1 - at if turn % 2 else at)
        first += groups
    return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    step_tokens: int = STEP_TOKENS,
    lot_tokens: int = LOT_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: (id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    tier, step_group) and, with ``with_ids``, the piece's ids as little-endian 32-bit numbers.

    Each task encodes and packs its own rows in lots of bounded size, so nothing is shuffled and
    a lost task gives the same pieces again. Sequences are full windows of a tier; a lot ends
    with a few shorter ones whose lengths are powers of two, so that nothing is padded.
    ``step_group`` numbers groups of sequences of one tier with ``step_tokens`` tokens at most, balanced
    within a lot by the squared lengths of their pieces, which attention costs (see ``step_groups``).
    A null text counts as empty and holds the end id alone; repeated rows, and rows whose id is
    null, are documents of their own; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker("pack_" + tokenizer_path, lambda: load_encoder(tokenizer_path))
        end = np.array([end_id], dtype="<u4")
        names, tokens, size = [], [], 0
        sequence, step = -1, 0

        def flush(partition: int) -> pa.RecordBatch:
            nonlocal sequence, step
            columns: list[list] = [[] for _ in schema]
            planned = list(plan([len(x) for x in tokens], tiers))
            costs = [sum(length * length for *_, length in pieces) for _, pieces in planned]
            groups = step_groups([tier for tier, _ in planned], costs, step_tokens)
            for (tier, pieces), group in zip(planned, groups, strict=True):
                sequence += 1
                offset = 0
                for doc, start, length in pieces:
                    part = tokens[doc][start : start + length].tobytes()
                    row = [
                        names[doc], start, length, zlib.crc32(part), len(tokens[doc]),
                        (partition << 32) + sequence, offset, tier, (partition << 32) + step + group,
                    ]
                    for column, value in zip(columns, row + [part] * with_ids, strict=True):
                        column.append(value)
                    offset += length
            step += max(groups, default=-1) + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(x, type=f.type) for x, f in zip(columns, arrow, strict=True)], schema=arrow
            )

        partition = 0
        for batch in batches:
            arrow = pa.schema([pa.field(id_col, batch.schema.field(0).type), *rest])
            for name, text, part in zip(*batch.columns, strict=True):
                partition = part.as_py()
                ids = encoder.encode_to_numpy(text.as_py() or "", allowed_special="all")
                names.append(name.as_py())
                tokens.append(np.concatenate([ids.astype("<u4"), end]))
                size += len(tokens[-1])
                if size >= lot_tokens:
                    yield flush(partition)
                    names, tokens, size = [], [], 0
        if names:
            yield flush(partition)
        names, tokens = [], []
        release_memory()

    rows = docs.select(F.col(id_col), F.col(text_col), F.spark_partition_id().alias("part"))
    longs = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")
    rest = [pa.field(x, pa.int64()) for x in longs] + [pa.field("ids", pa.binary())] * with_ids
    schema = T.StructType(
        [T.StructField(id_col, rows.schema[0].dataType)]
        + [T.StructField(x, T.LongType()) for x in longs]
        + [T.StructField("ids", T.BinaryType())] * with_ids
    )
    return rows.mapInArrow(run, schema)
