"""Repeated passages: content-defined chunks by a gear hash, deduplicated by digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bugsieve.llm.common import columns_of, free_names, per_worker, release_memory, saved

#: One word start in so many is a cut; so is every line start, and within long runs without
#: white space one character in CHAR_RATE.
WORD_RATE, CHAR_RATE, RUN_BYTES = 4, 64, 64
#: A chunk ends at the first cut at least so many bytes after its start, and at MAX_BYTES in any case.
MIN_BYTES, MAX_BYTES = 64, 4_096
#: Repeated chunks that join to fewer words are left alone.
MIN_WORDS = 30
#: A run without white space of more than LONG_WORD bytes, as in Chinese, Japanese or Thai or in
#: encoded data, counts as a word for every WORD_BYTES bytes.
LONG_WORD, WORD_BYTES = 32, 6
#: Rows of a batch cut at once, and bytes of a text seen at once; a longer one has several pieces,
#: which overlap.
ROWS = 500
PIECE_BYTES = 1_000_000
#: Bytes of short texts that are cut together, each as by itself.
LOT_BYTES = 200_000

_WINDOW = 16  # bytes that a 16-bit gear hash remembers


class _Tables:
    def __init__(self) -> None:
        rng = np.random.Generator(np.random.PCG64(20_240_501))
        self.gear = rng.integers(0, 1 << 16, 256, dtype=np.uint16)
        self.gear[0] = 0  # the byte between texts that are cut together
        self.value = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
        base = 0x9E3779B97F4A7C15 | 1
        n = PIECE_BYTES + 2 * MAX_BYTES + 4 * _WINDOW
        self.power = self._powers(base, n)
        self.inverse = self._powers(pow(base, -1, 1 << 64), n)
        self.space = np.zeros(256, dtype=bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


def _tables() -> _Tables:
    return per_worker("passages", _Tables)


def _cuts(data: np.ndarray, t: _Tables, firsts: np.ndarray | None = None) -> np.ndarray:
    """Whether a chunk may start at each byte, seen from the bytes just before and at it; ``firsts``
    are the places of the first bytes of texts that are cut together."""
    h = t.gear[data]
    reach = 1
    while reach < _WINDOW:  # h[i] = sum of gear[data[i - j]] << j over the window
        h[reach:] += h[:-reach] << np.uint16(reach)
        reach *= 2
    few = np.zeros(len(data), dtype=bool)  # by the bytes before: one word start in WORD_RATE
    few[0] = True
    few[1:] = h[:-1] < 65_536 // WORD_RATE
    space = t.space[data]
    start = ~space
    start[1:] &= space[:-1]
    cut = start & few
    cut[1:] |= (data[:-1] == 10) & ~space[1:]
    if firsts is not None:
        space[firsts - 1] = True  # as the start of a text does, the byte before it ends a run
    edges = np.concatenate(([-1], np.flatnonzero(space), [len(data)]))
    if (np.diff(edges) > RUN_BYTES + 1).any():  # long runs without white space
        last = np.maximum.accumulate(np.where(space, np.arange(len(data)), -1))
        far = (np.arange(len(data)) - last > RUN_BYTES) & ((data & 0xC0) != 0x80)
        rare = np.zeros(len(data), dtype=bool)
        rare[0] = True
        rare[1:] = h[:-1] < 65_536 // CHAR_RATE
        cut |= far & rare
    return cut


def _digests(piece: np.ndarray, starts: np.ndarray, ends: np.ndarray, t: _Tables) -> np.ndarray:
    sums = np.zeros(len(piece) + 1, dtype=np.uint64)
    np.cumsum(t.value[piece] * t.power[: len(piece)], dtype=np.uint64, out=sums[1:])
    x = (sums[ends] - sums[starts]) * t.inverse[starts] + (ends - starts).astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def chunks_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and digests of a text's chunks, which overlap: one starts at each cut.

    Cuts depend on a few bytes around them only, so the same passage has the same chunks
    wherever it stands, but for its edges. What is left of the text after the last cut pair
    of a chunk's length makes no chunk if it is shorter than that.
    """
    t = _tables()
    found = []
    for at in range(0, max(1, len(data)), PIECE_BYTES):
        lead = min(at, RUN_BYTES + _WINDOW)
        piece = np.frombuffer(data, dtype=np.uint8)[at - lead : at + PIECE_BYTES + MAX_BYTES]
        if not len(piece):
            break
        cut = _cuts(piece, t)
        if at == 0:
            cut[0] = True
        cut = np.flatnonzero(cut)
        starts = cut[(cut >= lead) & (cut < lead + PIECE_BYTES)]
        ends_at = np.r_[cut, len(piece)]
        ends = ends_at[np.minimum(np.searchsorted(cut, starts + MIN_BYTES), len(cut))]
        ends = np.minimum(ends, starts + MAX_BYTES)
        for _ in range(3):  # back to the start of a character
            ends -= (ends < len(piece)) & ((piece[np.minimum(ends, len(piece) - 1)] & 0xC0) == 0x80)
        long = ends - starts >= MIN_BYTES
        starts, ends = starts[long], ends[long]
        found.append((starts + (at - lead), ends + (at - lead), _digests(piece, starts, ends, t)))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def chunks_of_many(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``chunks_of`` of each text; short texts are cut together, some LOT_BYTES at a time."""
    out: list = [None] * len(texts)
    lot: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if len(text) > LOT_BYTES // 2:
            out[i] = chunks_of(text)
            continue
        if size + len(text) + _WINDOW > LOT_BYTES:
            _cut_together(texts, lot, out)
            lot, size = [], 0
        lot.append(i)
        size += len(text) + _WINDOW
    _cut_together(texts, lot, out)
    return out


def _cut_together(texts: list[bytes], lot: list[int], out: list) -> None:
    if not lot:
        return
    t, gap = _tables(), bytes(_WINDOW)
    data = np.frombuffer(gap + gap.join([texts[i] for i in lot]) + gap, dtype=np.uint8)
    sizes = np.array([len(texts[i]) for i in lot])
    firsts = _WINDOW + np.cumsum(sizes + _WINDOW) - (sizes + _WINDOW)
    lasts = firsts + sizes
    cut = _cuts(data, t, firsts)
    cut[firsts] = True
    cut = np.flatnonzero(cut)
    of = np.searchsorted(firsts, cut, "right") - 1
    inside = (of >= 0) & (cut < lasts[of])
    starts, of = cut[inside], of[inside]
    ends = np.append(cut, len(data))[np.searchsorted(cut, starts + MIN_BYTES)]
    ends = np.minimum(np.minimum(ends, lasts[of]), starts + MAX_BYTES)
    for _ in range(3):  # back to the start of a character
        ends -= (ends < lasts[of]) & ((data[ends] & 0xC0) == 0x80)
    long = ends - starts >= MIN_BYTES
    starts, ends, of = starts[long], ends[long], of[long]
    digests = _digests(data, starts, ends, t)
    edges = np.searchsorted(of, np.arange(len(lot) + 1)).tolist()
    for k, i in enumerate(lot):
        a, b = edges[k], edges[k + 1]
        out[i] = (starts[a:b] - firsts[k], ends[a:b] - firsts[k], digests[a:b])


def _chunk_rows(rows: DataFrame) -> DataFrame:
    """(id, digest) of each chunk. Where it stands is found again in the few texts that matter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = [x[2] for x in chunks_of_many(part.column(1).to_pylist())]
                ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), [len(x) for x in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, type=pa.int64()) for x in (ids, np.concatenate(found))], names=["id", "digest"]
                )
        release_memory()

    given = rows.where("id IS NOT NULL AND text IS NOT NULL").select("id", F.col("text").cast("binary"))
    return given.mapInArrow(run, "id long, digest long")


def _fine_chunks(data: bytes, lo: int, hi: int, by_end: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and digests of the chunks between two places, one from every word start to the
    first word end that makes MIN_BYTES, or to every word end from the last such start; within long
    runs without white space, every character counts as both."""
    t = _tables()
    lead = min(lo, RUN_BYTES + 1)
    piece = np.frombuffer(data, dtype=np.uint8)[lo - lead : hi + 1]
    space = t.space[piece]
    last = np.maximum.accumulate(np.where(space, np.arange(len(piece)), -1))
    far = (np.arange(len(piece)) - last > RUN_BYTES) & ((piece & 0xC0) != 0x80)
    after_space = np.r_[lo == lead, space[:-1]]
    starts = np.flatnonzero((after_space & ~space) | far)
    ends = np.flatnonzero((space & ~after_space) | far)
    if hi >= len(data):
        ends = np.r_[ends, len(piece)]
    starts = starts[starts >= lead]
    if by_end:
        at = np.searchsorted(starts, ends - MIN_BYTES, "right") - 1
        starts, ends = starts[at[at >= 0]], ends[at >= 0]
    else:
        at = np.searchsorted(ends, starts + MIN_BYTES)
        starts, ends = starts[at < len(ends)], ends[at[at < len(ends)]]
    return starts + (lo - lead), ends + (lo - lead), _digests(piece, starts, ends, t)


def _beyond(
    data: bytes, starts: np.ndarray, ends: np.ndarray, first: int, a: int, b: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The fine chunks that reach out of the span a to b of repeated chunks, the ``first`` of which
    starts at a: to the left as far as the text could go on without sharing the cut before, to the
    right as far as it could without sharing the chunk that ends next."""
    lo = int(starts[first - 1]) if first else 0
    if lo:  # what decides the cut
        lo -= _WINDOW if data[lo - 1] in b"\t\n\v\f\r " else RUN_BYTES + _WINDOW
    lo = max(0, lo, a - MAX_BYTES)
    after = int(np.searchsorted(ends, b, "right"))
    hi = min(int(ends[after]) if after < len(ends) else len(data), b + MAX_BYTES)
    most = MIN_BYTES + 2 * RUN_BYTES  # bytes of a fine chunk
    left = _fine_chunks(data, lo, min(len(data), a + most), False)
    right = _fine_chunks(data, max(lo, b - most), hi, True)
    here = left[0] < a
    there = right[1] > b
    return tuple(np.concatenate([x[here], y[there]]) for x, y in zip(left, right, strict=True))


def _spans(
    starts: np.ndarray, ends: np.ndarray, own: np.ndarray, digests: np.ndarray
) -> list[tuple[int, int, int, int]]:
    """The chunks with those digests as spans of bytes, joined where they touch, each with the
    numbers of its first chunk and of the one that ends it."""
    out: list[list[int]] = []
    for i in np.flatnonzero(np.isin(own, digests)).tolist():
        start, end = int(starts[i]), int(ends[i])
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1][1], out[-1][3] = end, i
        else:
            out.append([start, end, i, i])
    return [tuple(x) for x in out]


def words_in(data: bytes) -> int:
    """Words of a text, where a long run without white space counts by its size."""
    return sum(1 if len(w) <= LONG_WORD else -(-len(w) // WORD_BYTES) for w in data.split())


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _looked_at(joined: DataFrame, text: int, lists: int, fields: list[str]) -> DataFrame:
    """The rows with what their chunks of the digests in column ``lists`` come to, as ``fields``: the
    first and last chunk of each span, the spans' starts and ends, and digests, starts and ends of the
    fine chunks around them. Lists of digests are left empty."""
    names = list(joined.columns)
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            made: list[list] = [[None] * batch.num_rows for _ in fields]
            digests = batch.column(lists)
            cut = np.flatnonzero(digests.is_valid().to_numpy(zero_copy_only=False)).tolist()
            texts = [(batch.column(text)[i].as_py() or "").encode() for i in cut]
            for i, data, (starts, ends, own) in zip(cut, texts, chunks_of_many(texts), strict=True):
                found = _spans(starts, ends, own, digests[i].values.to_numpy())
                around = [_beyond(data, starts, ends, first, a, b) for a, b, first, _ in found]
                left, right, fine = (np.concatenate([x[k] for x in around]) if around else [] for k in range(3))
                row = (
                    np.unique(own[[k for x in found for k in x[2:]]]) if found else [],
                    [x[0] for x in found], [x[1] for x in found], fine, left, right,
                )
                for column, value in zip(made, row, strict=True):
                    column[i] = value
            columns = list(batch.columns)
            cut_now = set(cut)  # the digests themselves have served: only whether there were any is kept
            columns[lists] = pa.array([[] if i in cut_now else None for i in range(batch.num_rows)], type=longs)
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(x, type=longs) for x in made)], names=[*names, *fields]
            )
        release_memory()

    more = [T.StructField(f, T.ArrayType(T.LongType())) for f in fields]
    return joined.mapInArrow(run, T.StructType([*joined.schema.fields, *more]))


def _around_owners(joined: DataFrame, text: int, lists: int, key: int) -> DataFrame:
    """(id, fine): the fine chunks around each chunk of the digests in column ``lists``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            ids, fine = [], []
            texts = [(x or "").encode() for x in batch.column(text).to_pylist()]
            for i, (data, (starts, ends, own)) in enumerate(zip(texts, chunks_of_many(texts), strict=True)):
                at = np.flatnonzero(np.isin(own, batch.column(lists)[i].values.to_numpy())).tolist()
                if at:
                    ids.append(batch.column(key)[i].as_py())
                    around = [_beyond(data, starts, ends, k, int(starts[k]), int(ends[k]))[2] for k in at]
                    fine.append(np.unique(np.concatenate(around)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, type=pa.int64()), pa.array(fine, type=pa.list_(pa.int64()))], names=["id", "fine"]
            )
        release_memory()

    return joined.mapInArrow(run, "id long, fine array<long>")


def _cut_lists(chunks: DataFrame, names: tuple[str, str, str]) -> tuple[DataFrame, DataFrame]:
    """For each document that must give way, its repeated digests and their owners; and (digest,
    owner) of the digests that several documents have.

    The owners are a table, so that the join has exchanges of its own on both sides and Spark can
    split the partition of a digest that very many documents have.
    """
    owners = saved(
        chunks.groupBy("digest").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
        .where("owner < last").select("digest", "owner"),
        "owners",
    )
    lists = (
        chunks.join(owners, "digest").where("id <> owner").groupBy("id")
        .agg(F.collect_set("digest"), F.collect_set("owner")).toDF(*names)
    )
    return lists, owners


def remove_repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The rows with repeated passages cut out of ``text_col``, and three columns more:
    ``removed_chars``, ``removed_spans`` (start and end in characters of the text before) and
    ``kept_in`` (ids of the documents that keep the chunks removed here); columns of these
    names in ``docs`` give way.

    A chunk that occurs in several documents belongs to the one with the smallest id, which
    keeps every copy of it; repeats within one document are no matter of this operator. In other
    documents, repeated chunks that touch are joined and extended on both sides to the last whole
    word that is repeated too (in long runs without white space, to some ``RUN_BYTES`` bytes): the
    chunks from every word start around the edges, of documents and owners alike, have owners by
    their digests as well. Spans of at least ``min_words`` words are cut out;
    runs of more than ``LONG_WORD`` bytes without white space count as a word per ``WORD_BYTES``
    bytes. Owners are found by partial aggregation, so a passage of very many documents sends one
    row a task; the rows that are to be cut meet their owner in a join of tables whose hot
    partitions Spark splits. Each step that more than one other reads is written once, and only texts
    that are cut or keep what others lose go through the later ones. A row with a null id or text stays as it is; rows with the same id
    are one document; an empty text has no chunks; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    docs = docs.select(*columns_of(docs, ("removed_chars", "removed_spans", "kept_in")))
    doc, digests, owned, key, fine, by, owner, other, *look = free_names(
        docs, "doc_", "digests_", "owners_", "key_", "fine_", "by_", "owner_", "other_",
        "anchors_", "starts_", "ends_", "around_", "lefts_", "rights_",
    )
    keyed = docs.withColumn(key, F.col(f"`{id_col}`").cast("long"))
    columns = columns_of(docs)
    cuts, owners = _cut_lists(_chunk_rows(rows), (doc, digests, owned))
    cuts = saved(cuts, "cuts")
    # The texts that are cut or keep what others lose; no other text goes through the steps below.
    keepers = cuts.select(F.explode(owned).alias(owner)).distinct()
    texts, n = docs.columns.index(text_col), len(columns)
    some = (
        keyed.join(cuts, F.col(key) == F.col(doc), "left").join(keepers, F.col(key) == F.col(owner), "left")
        .where(F.col(doc).isNotNull() | F.col(owner).isNotNull())
        .select(*columns, key, digests, owned)
    )
    some = saved(_looked_at(some, texts, n + 1, look), "touched")
    touched = some.where(F.col(digests).isNotNull())
    # Both sides of each span's edges: the fine chunks of the documents and of their owners.
    anchors = (
        touched.select(F.explode(look[0]).alias("digest")).distinct().join(owners, "digest")
        .groupBy("owner").agg(F.collect_set("digest")).toDF(doc, other)
    )
    theirs = some.join(anchors, F.col(key) == F.col(doc)).select(*columns, key, other)
    edges = saved(
        touched.select(F.col(key).alias("id"), F.explode(F.array_distinct(look[3])).alias("digest")).unionByName(
            _around_owners(theirs, texts, n + 1, n).select("id", F.explode("fine").alias("digest"))
        ),
        "edges",
    )
    more, _ = _cut_lists(edges, (other, fine, by))
    joined = touched.join(more, F.col(key) == F.col(other), "left").select(*columns, owned, fine, by, *look[1:])
    n, place = len(docs.columns), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            texts = batch.column(place)
            owner_lists, fine_lists, by_lists, *kept_of_look = (batch.column(n + k) for k in range(8))
            touched = {}
            for i in range(batch.num_rows):
                data = (texts[i].as_py() or "").encode()
                a, b, own, left, right = (x[i].values.to_numpy() for x in kept_of_look)
                spans = list(zip(a.tolist(), b.tolist(), strict=True))
                extended = fine_lists[i].is_valid
                if extended:  # by the fine chunks that others have too
                    again = np.isin(own, fine_lists[i].values.to_numpy())
                    spans += zip(left[again].tolist(), right[again].tolist(), strict=True)
                found = _joined(spans)
                cut = [(a, b) for a, b in found if words_in(data[a:b]) >= min_words]
                if cut:
                    ends = [0, *(b for _, b in cut)]
                    kept = [data[a:b] for a, b in zip(ends, [*(a for a, _ in cut), len(data)], strict=True)]
                    spans, done, at = [], 0, 0
                    for a, b in cut:
                        done += len(data[at:a].decode())
                        length = len(data[a:b].decode())
                        spans.append({"start": done, "end": done + length})
                        done, at = done + length, b
                    keepers = {*owner_lists[i].as_py(), *(by_lists[i].as_py() if extended else ())}
                    touched[i] = (b"".join(kept).decode(), spans, sorted(keepers))
            columns = list(batch.columns[:n])
            if touched:
                columns[place] = pa.array(
                    [touched[i][0] if i in touched else x.as_py() for i, x in enumerate(texts)], type=texts.type
                )
            given = [touched.get(i, (None, [], [])) for i in range(batch.num_rows)]
            columns += [
                pa.array([sum(s["end"] - s["start"] for s in g[1]) for g in given], type=pa.int64()),
                pa.array([g[1] for g in given], type=span_type),
                pa.array([g[2] for g in given], type=pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=[*docs_names, "removed_chars", "removed_spans", "kept_in"]
            )
        release_memory()

    docs_names = list(docs.columns)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([
        *docs.schema.fields, T.StructField("removed_chars", T.LongType()),
        T.StructField("removed_spans", T.ArrayType(span)), T.StructField("kept_in", T.ArrayType(T.LongType())),
    ])
    whole = (
        keyed.join(cuts.select(doc), F.col(key) == F.col(doc), "left_anti").select(*columns)
        .withColumn("removed_chars", F.lit(0).cast("long"))
        .withColumn("removed_spans", F.array().cast(T.ArrayType(span)))
        .withColumn("kept_in", F.array().cast("array<long>"))
    )
    return joined.mapInArrow(run, schema).unionByName(whole)
