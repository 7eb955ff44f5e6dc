"""License notices in documents: MinHash bands retrieve templates, exact containment verifies."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Probability with which a window that holds a template must share a band with it.
FOUND = 0.9999

# Public license notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "mit": "Released under the MIT License",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "bsd-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nc-nd-4.0": "Licensed under CC BY-NC-ND 4.0",
    "cc-by-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc0-1.0": (
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright "
        "and related or neighboring rights to this work"
    ),
    "lgpl-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation"
    ),
    "agpl-3.0": "under the terms of the GNU Affero General Public License",
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "unlicense": "This is free and unencumbered software released into the public domain",
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
        "be held liable for any damages arising from the use of this software"
    ),
    "boost-1.0": "Distributed under the Boost Software License, Version 1.0",
    "all-rights-reserved": "All rights reserved",
}

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _hash_words(words: list[str], memo: dict[str, int]) -> np.ndarray:
    for w in set(words).difference(memo):
        memo[w] = xxhash.xxh64_intdigest(w, 5)
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))


def _shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    return out ^ (out >> np.uint64(29))


class _Class:
    """Templates that share a window length, with their MinHash bands (of one row each)."""

    def __init__(self, names: list[str], words: list[list[str]], k: int, window: int, similarity: float, memo: dict) -> None:
        # Any `window` words lie whole in one of the spans looked up, which overlap by that.
        self.names, self.k, self.window, self.step = names, k, window, max(1, window // 2)
        self.looked = window + self.step
        self.sets = [{tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for w in words]
        hashed = [np.unique(_shingles(_hash_words(w, memo), k)) for w in words]
        self.any = np.unique(np.concatenate(hashed))
        # A window that holds a part `similarity` of a template has at least this Jaccard
        # similarity with it, so so many bands miss it with probability 1 - FOUND at most.
        least = min(
            math.ceil(similarity * len(s)) / (self.looked - k + 1 + len(s) - math.ceil(similarity * len(s))) for s in self.sets
        )
        bands = max(1, math.ceil(math.log(1 - FOUND) / math.log(1 - min(least, 1 - 1e-9))))
        rng = np.random.Generator(np.random.PCG64(k * 1_000 + window))
        self.factor = rng.integers(1, 1 << 63, bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.offset = rng.integers(0, 1 << 63, bands, dtype=np.uint64)
        self.signatures = np.stack([self.signature(h) for h in hashed])

    def best(self, i: int, words: list[str], at: np.ndarray) -> tuple[float, int]:
        """The largest share of a template's shingles in any window of `words`, and the first shingle
        of the first such window; ``at``: where shingles of the class start."""
        span, counts, low, best = self.window - self.k + 1, {}, 0, (0, 0)
        own = [(p, t) for p in at.tolist() if (t := tuple(words[p : p + self.k])) in self.sets[i]]
        for p, t in own:
            counts[t] = counts.get(t, 0) + 1
            while own[low][0] <= p - span:
                gone = own[low][1]
                counts[gone] -= 1
                if not counts[gone]:
                    del counts[gone]
                low += 1
            if len(counts) > best[0]:
                best = len(counts), own[low][0]
        return best[0] / len(self.sets[i]), best[1]

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        x = shingles[:, None] * self.factor + self.offset
        return ((x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)).min(axis=0)


class Scanner:
    """Finds templates in texts."""

    def __init__(self, templates: dict[str, str], similarity: float = SIMILARITY, shingle_words: int = SHINGLE_WORDS) -> None:
        self.similarity = similarity
        self.memo: dict[str, int] = {}
        grouped: dict[tuple[int, int], list[str]] = {}
        split = {name: words_of(text) for name, text in templates.items()}
        for name, words in split.items():
            if words:
                k = min(shingle_words, len(words))
                # Windows of twice the words: a notice may have as many words put between its own.
                window = 2 * math.ceil(1.25 ** math.ceil(math.log(len(words), 1.25) - 1e-9))
                grouped.setdefault((k, window), []).append(name)
        self.classes = [
            _Class(names, [split[x] for x in names], k, window, similarity, self.memo)
            for (k, window), names in sorted(grouped.items())
        ]

    def scan(self, text: str | None) -> list[tuple[str, float, int]]:
        """(template, containment, first matching word of its best window) of each template found."""
        words = words_of(text)
        if len(self.memo) > 300_000:
            self.memo.clear()
        hashes = _hash_words(words, self.memo)
        best: dict[str, tuple[float, int]] = {}
        by_k: dict[int, np.ndarray] = {}
        for c in self.classes:
            if len(words) < c.k:
                continue
            if c.k not in by_k:
                by_k[c.k] = _shingles(hashes, c.k)
            shingles = by_k[c.k]
            # A window without any template shingle has similarity zero and equal bands with none.
            at = np.flatnonzero(c.any[np.minimum(np.searchsorted(c.any, shingles), len(c.any) - 1)] == shingles)
            if not len(at):
                continue
            span = c.looked - c.k + 1
            last = max(0, -(-(len(words) - c.looked) // c.step))
            low = np.maximum(0, -(-(at - span + 1) // c.step))
            high = np.minimum(at // c.step, last)
            areas: dict[int, list[list[int]]] = {}  # of each template, looked-up spans joined with their neighbours
            for w in sorted({int(x) for a, b in zip(low, high, strict=True) for x in range(a, b + 1)}):
                start = w * c.step
                signature = c.signature(shingles[start : start + span])
                for i in np.flatnonzero((c.signatures == signature).any(axis=1)):
                    found = areas.setdefault(int(i), [])
                    a, b = start - c.step, start + span + c.step
                    if found and a <= found[-1][1]:
                        found[-1][1] = b
                    else:
                        found.append([a, b])
            for i, found in areas.items():
                for a, b in found:
                    share, start = c.best(i, words, at[np.searchsorted(at, a) : np.searchsorted(at, b)])
                    if share >= self.similarity and share > best.get(c.names[i], (0.0, 0))[0]:
                        best[c.names[i]] = (share, start)
        return sorted((name, share, start) for name, (share, start) in best.items())


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text",
    similarity: float = SIMILARITY, shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """(id_col, license, containment, first_word): a row per document and template found in it.

    Texts and templates are compared as lower-case words. Spans that hold any window of twice a
    template's words whole are looked up; one that shares a MinHash band with a template is a
    candidate, and the exact share of the template's distinct shingles in the best window at any
    start, in that span joined with its neighbours, must reach ``similarity``: where in the text
    a notice stands makes no difference. A template with fewer words than a
    shingle is one shingle. Null, empty and clean texts give no rows; repeated rows each give
    theirs; an empty table, or no template with a word, gives no rows; other columns are ignored.
    Templates are few and travel with the job.
    """
    rows = docs.select(F.col(id_col), F.col(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, similarity, shingle_words)
        for batch in batches:
            ids, found = [], []
            for i, text in enumerate(batch.column(1)):
                for hit in scanner.scan(text.as_py()):
                    ids.append(i)
                    found.append(hit)
            names, shares, starts = zip(*found, strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(ids, type=pa.int64())), pa.array(names, type=pa.string()),
                    pa.array(shares, type=pa.float64()), pa.array(starts, type=pa.int64()),
                ],
                names=[id_col, "license", "containment", "first_word"],
            )

    schema = T.StructType([
        T.StructField(id_col, rows.schema[0].dataType), T.StructField("license", T.StringType()),
        T.StructField("containment", T.DoubleType()), T.StructField("first_word", T.LongType()),
    ])
    return rows.mapInArrow(run, schema)
