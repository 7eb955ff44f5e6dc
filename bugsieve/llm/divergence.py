"""Source divergence: how far the term distributions of sources lie apart, by count-level bitmaps."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bugsieve.llm.common import release_memory, saved

#: A term counts if so many documents of its language have it, and each count is raised by so much.
MIN_DOCUMENTS, SMOOTHING = 30, 5
#: Probabilities are whole numbers of this unit.
UNIT = 1_000_000_000
#: Rows of the term report of a group.
TERM_RANKS = 50
#: Terms of one bitmap, sources of one block, cells computed at once, terms numbered together.
BITS, BLOCK, CELLS, LOT_TERMS = 64, 128, 1 << 21, 4_096
#: Distinct (group, term) entries a task holds before it hands them on, some 200 bytes each.
HELD = 1_000_000

# A term is a run of letters A-Z, in lower case, and of all characters beyond ASCII.
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, cnt, docs): occurrences and documents of each term in each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def rows() -> pa.RecordBatch:
            flat = [(*g, t, n, own[t]) for g, (all_, own) in counts.items() for t, n in all_.items()]
            columns = zip(*flat, strict=True) if flat else [[]] * 5
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
            made = [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [*made[:2], made[2].cast(pa.string()), *made[3:]], names=["lang", "source", "term", "cnt", "docs"]
            )

        held = 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for group, text in zip(zip(langs, sources, strict=True), batch.column(2), strict=True):
                all_, own = counts[group]
                before = len(all_)
                words = _TERM.findall(text.as_buffer().to_pybytes().lower())  # of bytes: A-Z only
                all_.update(words)
                own.update(set(words))
                held += len(all_) - before
                if held >= HELD:
                    yield rows()
                    held = 0
        yield rows()
        release_memory()

    found = docs.mapInArrow(run, "lang string, source string, term string, cnt long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("cnt").alias("cnt"), F.sum("docs").alias("docs"))


def _probability(count: str, total: str, terms: str) -> Column:
    """1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * terms)), exactly; null without terms."""
    return F.expr(
        f"1L + (CAST({UNIT} AS DECIMAL(10,0)) * CAST({count} + {SMOOTHING} AS DECIMAL(19,0))"
        f" div nullif(CAST({total} AS DECIMAL(19,0)) + CAST({SMOOTHING} AS DECIMAL(2,0)) * {terms}, 0))"
    )


def _numbered(totals: DataFrame) -> DataFrame:
    """The kept terms with the bitmap (lang, band, part, map) and the bit that stand for each.

    Terms of like frequency share a band, so that the groups have few count levels in a bitmap; a
    band is numbered in parts of some LOT_TERMS terms, so no task numbers a whole vocabulary.
    """
    banded = totals.withColumn("band", F.floor(F.log2(F.col("total").cast("double")) * 2).cast("int"))
    sizes = banded.groupBy("lang", "band").agg(F.ceil(F.count(F.lit(1)) / LOT_TERMS).alias("parts"))
    parted = banded.join(sizes, ["lang", "band"]).withColumn(
        "part", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int")
    ).repartition("lang", "band", "part")
    place = F.row_number().over(Window.partitionBy("lang", "band", "part").orderBy("total", "term")) - 1
    return parted.withColumn("place", place).select(
        "lang", "term", "total", "band", "part", F.floor(F.col("place") / BITS).cast("int").alias("map"),
        (F.col("place") % BITS).cast("int").alias("bit"),
    )


def _unit_sums(
    no_a: np.ndarray, p_a: np.ndarray, bits_a: np.ndarray, zero_a: np.ndarray,
    no_b: np.ndarray, p_b: np.ndarray, bits_b: np.ndarray, zero_b: np.ndarray,
) -> np.ndarray:
    """For each pair of groups of two blocks, the sum of |p - q| over the terms of one bitmap, less
    that of the terms as if no group had any (which is added once for all bitmaps).

    Levels (group number, probability, bits) meet by AND and popcount, which gives the joint cells of
    two counts above zero. Cells with a zero on one side are what is left of a level's own popcount:
    each joint term is taken from both of its zero cells and given back to the cell of two zeros.
    """
    out = np.zeros((len(zero_a), len(zero_b)), dtype=np.int64)
    ends_a = np.abs(p_a[:, None] - zero_b) - np.abs(zero_a[no_a][:, None] - zero_b)  # to each zero of b
    ends_b = np.abs(p_b[:, None] - zero_a) - np.abs(zero_b[no_b][:, None] - zero_a)
    np.add.at(out, no_a, ends_a * np.bitwise_count(bits_a).astype(np.int64)[:, None])
    np.add.at(out.T, no_b, ends_b * np.bitwise_count(bits_b).astype(np.int64)[:, None])
    if not len(no_b):
        return out
    order = np.argsort(no_b, kind="stable")
    no_b, p_b, bits_b, ends_b = no_b[order], p_b[order], bits_b[order], ends_b[order]
    starts = np.flatnonzero(np.r_[True, np.diff(no_b) > 0])
    for at in range(0, len(no_a), step := max(1, CELLS // len(no_b))):
        some = slice(at, at + step)
        joint = np.bitwise_count(bits_a[some, None] & bits_b).astype(np.int64)
        f = np.abs(p_a[some, None] - p_b) - ends_a[some][:, no_b] - ends_b[:, no_a[some]].T
        f -= np.abs(zero_a[no_a[some]][:, None] - zero_b[no_b])
        np.add.at(out, (no_a[some][:, None], no_b[starts]), np.add.reduceat(joint * f, starts, axis=1))
    return out


def _joint_cells(units: DataFrame) -> DataFrame:
    """(lang, no, other, value): what the bitmaps of a task add to each pair of groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}

        def rows() -> pa.RecordBatch:
            langs, no, other, value = [], [], [], []
            for (lang, a, b), m in sums.items():
                i, j = np.nonzero(m)
                both = [(i + a * BLOCK, j + b * BLOCK)] if a == b else [
                    (i + a * BLOCK, j + b * BLOCK), (j + b * BLOCK, i + a * BLOCK)]
                for left, right in both:
                    langs += [lang] * len(left)
                    no.append(left)
                    other.append(right)
                    value.append(m[i, j])
            sums.clear()
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (no, other, value)]
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, type=pa.string()), *(pa.array(x.astype(np.int64)) for x in flat)],
                names=["lang", "no", "other", "value"],
            )

        for batch in batches:
            langs, a, b = (batch.column(i).to_pylist() for i in range(3))
            for i in range(batch.num_rows):
                levels, zeros_a, zeros_b = (batch.column(k)[i].values for k in (3, 4, 5))
                no, p, bits = (x.to_numpy(zero_copy_only=False) for x in levels.flatten())
                zero_a, zero_b = zeros_a.to_numpy(), zeros_b.to_numpy()
                bits = bits.view(np.uint64)
                in_a, in_b = no // BLOCK == a[i], no // BLOCK == b[i]
                key = (langs[i], a[i], b[i])
                if key not in sums and len(sums) >= 64:
                    yield rows()
                found = _unit_sums(
                    no[in_a] - a[i] * BLOCK, p[in_a], bits[in_a], zero_a,
                    no[in_b] - b[i] * BLOCK, p[in_b], bits[in_b], zero_b,
                )
                sums[key] = sums[key] + found if key in sums else found
        yield rows()
        release_memory()

    return units.mapInArrow(run, "lang string, no long, other long, value long")


def audit_sources(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    min_documents: int = MIN_DOCUMENTS, term_ranks: int = TERM_RANKS,
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) group.

    Terms are runs of letters A-Z, lower-cased, and characters beyond ASCII; a language keeps the V
    terms that ``min_documents`` of its rows have. A group gives a kept term the probability
    p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)), N its sum of counts; a language does so too.
    Part ``pair``: for each other source of the language, the sum over kept terms of the difference
    of their probabilities, all ranks. Part ``term``: the kept terms that the group has
    and favours against its language, by the difference, to ``term_ranks``. Larger values first,
    equal ones by the UTF-8 order of the item.

    Texts are counted in tasks and combined before the shuffle. Each bitmap of 64 terms holds a
    bitset per (group, count); the pairs of a bitmap meet in one small unit of work, keyed by
    bitmap and block of sources, so a source or language with most of the rows is no task of its
    own. Counts, and those of the kept terms, are written as tables that the parts read. Null texts, languages and
    sources are empty strings; repeated rows count again; a group without terms has zero counts;
    where no term is kept every pair has value 0 and part ``term`` has no rows; an empty table gives no
    rows; a language with one source has no pairs; other columns are ignored.
    """
    given = docs.select(*(
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
        for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
    ))
    counts = saved(term_counts(given), "divergence-counts")
    totals = counts.groupBy("lang", "term").agg(F.sum("cnt").alias("total"), F.sum("docs").alias("docs"))
    kept = saved(_numbered(totals.where(F.col("docs") >= min_documents).drop("docs")), "divergence-terms")
    in_kept = saved(
        counts.select("lang", "source", "term", "cnt").join(kept, ["lang", "term"]), "divergence-kept-counts"
    )

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = (
        given.select("lang", "source").distinct()
        .join(in_kept.groupBy("lang", "source").agg(F.sum("cnt").alias("own")), ["lang", "source"], "left")
        .join(sizes, "lang", "left").na.fill(0, ["own", "terms", "lang_total"])
        .withColumn("no", number.cast("long")).withColumn("zero", F.coalesce(_probability("0", "own", "terms"), F.lit(0)))
    )
    groups = saved(groups, "divergence-groups")

    # Bitsets per (group, count) of each bitmap, with the probability that the count has there.
    levels = (
        in_kept.groupBy("lang", "band", "part", "map", "source", "cnt")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .join(groups, ["lang", "source"]).withColumn("p", _probability("cnt", "own", "terms"))
        .withColumn("block", F.floor(F.col("no") / BLOCK).cast("int"))
    )
    blocks = groups.groupBy("lang", F.floor(F.col("no") / BLOCK).cast("int").alias("block")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("no", "zero"))), lambda x: x["zero"]).alias("zeros")
    )
    most = blocks.groupBy("lang").agg(F.max("block").alias("last"))
    paired = levels.join(most, "lang").withColumn("other", F.explode(F.expr("sequence(0, last)"))).select(
        "lang", "band", "part", "map", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
        F.struct("no", "p", "bits").alias("level"),
    )
    units = (
        paired.groupBy("lang", "band", "part", "map", "a", "b").agg(F.collect_list("level").alias("levels"))
        .join(blocks.toDF("lang", "a", "zeros_a"), ["lang", "a"]).join(blocks.toDF("lang", "b", "zeros_b"), ["lang", "b"])
        .select("lang", "a", "b", "levels", "zeros_a", "zeros_b")
    )
    mine = groups.select("lang", "no", "source", "zero", "terms")
    theirs = groups.select("lang", F.col("no").alias("other"), F.col("source").alias("item"), F.col("zero").alias("zero_"))
    pairs = mine.join(theirs, "lang").where("no <> other")  # the rows of the result
    sums = _joint_cells(units).groupBy("lang", "no", "other").agg(F.sum("value").alias("value"))
    by_pair = pairs.join(sums, ["lang", "no", "other"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item",
        (F.coalesce("value", F.lit(0)) + F.col("terms") * F.abs(F.col("zero") - F.col("zero_"))).alias("value"),
    )
    by_term = (
        in_kept.join(groups.select("lang", "source", "own", "terms", "lang_total"), ["lang", "source"])
        .withColumn("value", _probability("cnt", "own", "terms") - _probability("total", "lang_total", "terms"))
        .where("cnt > 0 AND value > 0")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(order).alias("rank")
    top = by_term.select("*", ranked).where(F.col("rank") <= term_ranks)  # cut to the ranks before the shuffle too
    return by_pair.select("*", ranked).unionByName(top)
