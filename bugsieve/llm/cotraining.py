"""Quality classifier by co-training: text content and page metadata teach each other."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bugsieve.llm.common import appended, columns_of, free_names

#: Labelled rows and unlabelled rows used for fitting at most; both bound what the driver holds.
LABELLED_ROWS, POOL_ROWS = 6_000, 4_000
#: Rounds of exchange, pseudo-labels a view may add in a round, and the confidence they need.
ROUNDS, ADDED, CONFIDENCE = 4, 400, 0.98
#: Share of the held-out good rows that the threshold must keep.
KEEP_GOOD = 0.998
#: Hashed byte pairs, languages, sources and length steps.
PAIRS, LANGS, SOURCES, STEPS = 256, 16, 64, 24

_MARKS = np.array([not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123 or b >= 128 or b in b" \t\n\r\x0b\x0c") for b in range(256)])
_FOLD = np.array([xxhash.xxh32_intdigest(i.to_bytes(2, "little"), 17) % PAIRS for i in range(1 << 16)], dtype=np.int32)


def text_features(text: str | None) -> np.ndarray:
    """What a text is made of: shares of kinds of characters and words, and hashed byte pairs."""
    data = (text or "").encode()
    raw = np.frombuffer(data, dtype=np.uint8)
    words = data.split()
    n, m = max(1, len(raw)), max(1, len(words))
    counts = np.bincount(raw, minlength=256)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    shares = [
        counts[_MARKS].sum() / n, counts[65:91].sum() / n, counts[48:58].sum() / n, counts[128:].sum() / n,
        counts[[9, 10, 11, 12, 13, 32]].sum() / n, len(set(words)) / m, same / m,
        min(20.0, len(raw) / m) / 20, math.log1p(len(words)) / 12,
    ]
    pairs = np.zeros(PAIRS)
    if len(raw) > 1:
        code = raw[:-1].astype(np.int32) << 8 | raw[1:]
        pairs = np.sqrt(np.bincount(_FOLD[code], minlength=PAIRS) / (len(raw) - 1))
    return np.r_[shares, pairs].astype(np.float32)


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """A page's metadata: hashed language and source, and its stated length in steps."""
    out = np.zeros(LANGS + SOURCES + STEPS + 2, dtype=np.float32)
    out[xxhash.xxh32_intdigest((lang or "").encode(), 1) % LANGS] = 1
    out[LANGS + xxhash.xxh32_intdigest((source or "").encode(), 2) % SOURCES] = 1
    length = max(0, n_chars or 0)
    out[LANGS + SOURCES + min(STEPS - 1, int(2 * math.log2(length + 1) / 2))] = 1
    out[-2] = n_chars is None
    out[-1] = math.log1p(length) / 12
    return out


@dataclass
class Linear:
    """Logistic regression on scaled features, with a calibration of its scores."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * (((x - self.mean) / self.scale) @ self.weights + self.bias) + self.shift


def _newton(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    full = np.c_[x, np.ones(len(x))]
    beta = np.zeros(full.shape[1])
    penalty = np.full(full.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(full @ beta, -30, 30)))
        grad = full.T @ (w * (p - y)) + penalty * beta
        step = np.linalg.solve((full * (w * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ full + np.diag(penalty), grad)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 3.0) -> Linear:
    """Classes weigh the same, whatever their sizes."""
    x = x.astype(np.float64)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    weights, bias = _newton((x - mean) / scale, y, w, ridge)
    return Linear(mean, scale, weights, bias)


def calibrate(model: Linear, x: np.ndarray, y: np.ndarray) -> Linear:
    """Fit slope and shift so that scores on held-out rows are log odds."""
    z = model.logit(x.astype(np.float64))
    slope, shift = _newton(np.clip(z, -30, 30)[:, None], y, np.ones(len(y)), 0.1)
    model.slope, model.shift = max(0.0, float(slope[0])), shift
    return model


@dataclass
class CoTrained:
    """Two calibrated views, the weights of their log odds, and the threshold for keeping."""

    text: Linear
    meta: Linear
    weights: tuple[float, float]
    bias: float
    threshold: float

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = np.clip(self.text.logit(text), -30, 30)
        b = np.clip(self.meta.logit(meta), -30, 30)
        both = self.weights[0] * a + self.weights[1] * b + self.bias
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (a, b, both))


def co_train(
    text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray, seed: int = 11
) -> CoTrained | None:
    """None if the labels lack a class. A third of the labelled rows is held out for calibration,
    for the weights of the views and for the threshold. In each round a view labels the pool rows
    it is most sure of, in the labelled classes' proportion, and the other view learns them."""
    rng = np.random.default_rng(seed)
    held = rng.integers(0, 3, len(y)) == 0
    if min((y[held] == 0).sum(), (y[held] == 1).sum(), (y[~held] == 0).sum(), (y[~held] == 1).sum()) == 0:
        return None
    views, pools = (text, meta), (pool_text, pool_meta)
    taught: list[dict[int, int]] = [{}, {}]  # pool row -> label given by the other view
    share = y.mean()

    def train(i: int) -> Linear:
        rows = list(taught[i])
        x = np.concatenate([views[i][~held], pools[i][rows]])
        model = fit(x, np.r_[y[~held], [taught[i][r] for r in rows]])
        return calibrate(model, views[i][held], y[held])

    models = [train(0), train(1)]
    for _ in range(ROUNDS):
        grew = False
        for i, model in enumerate(models):
            if not len(pools[i]):
                continue
            p = 1 / (1 + np.exp(-np.clip(model.logit(pools[i]), -30, 30)))
            for label, sure, most in ((1, p, int(ADDED * share)), (0, 1 - p, int(ADDED * (1 - share)) + 1)):
                order = [int(r) for r in np.argsort(-sure, kind="stable") if sure[r] >= CONFIDENCE and int(r) not in taught[1 - i]]
                for row in order[:most]:
                    taught[1 - i][row] = label
                    grew = True
        if not grew:
            break
        models = [train(0), train(1)]
    z = np.stack([np.clip(m.logit(v[held]), -30, 30) for m, v in zip(models, views, strict=True)], axis=1)
    weights, bias = _newton(z, y[held], np.ones(held.sum()), 0.1)
    out = CoTrained(*models, (float(weights[0]), float(weights[1])), bias, 0.0)
    good = out.scores(text[held], meta[held])[2][y[held] == 1]
    out.threshold = min(0.5, float(np.quantile(good, 1 - KEEP_GOOD, method="lower")))
    return out


def _feature_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, lang, source, n in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True):
                out.append(np.r_[text_features(text), meta_features(lang, source, n)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, type=pa.binary())], names=["id", "features"]
            )

    return rows.select("id", "text", "lang", "source", "n_chars").mapInArrow(run, "id long, features binary")


def fit_on(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, pool_rows: int = POOL_ROWS) -> CoTrained | None:
    """Fit on bounded samples: the rows whose ids have the smallest hashes, labelled and not."""
    spark = docs.sparkSession
    rows = docs.withColumnRenamed("doc_id", "id").where("id IS NOT NULL").withColumn("id", F.col("id").cast("long"))
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("id")
    ).agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(labelled_rows).collect()
    label = {r.id: int(r.quality != 0) for r in chosen}
    ids = rows.select("id").distinct().orderBy(F.xxhash64("id", F.lit("pool")), "id").limit(pool_rows).collect()
    wanted = sorted(label.keys() | {r.id for r in ids})
    if not wanted:
        return None
    frame = spark.createDataFrame([(x,) for x in wanted], "id long")
    found = _feature_rows(rows.join(F.broadcast(frame), "id", "left_semi")).limit(labelled_rows + pool_rows).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.id, bytes(r.features)))
    x = np.stack([np.frombuffer(r.features, dtype=np.float32) for r in found])
    is_known = np.array([r.id in label for r in found])
    cut = 9 + PAIRS
    y = np.array([label[r.id] for r in found if r.id in label], dtype=np.int64)
    return co_train(x[is_known, :cut], x[is_known, cut:], y, x[~is_known, :cut], x[~is_known, cut:])


SCORES = ("text_score", "meta_score", "score")


def _scored(frame: DataFrame, names: list[str], model: CoTrained | None) -> DataFrame:
    """The frame with the three scores and the verdict, from its text, lang, source and n_chars."""

    def work(texts: pa.Array, langs: pa.Array, sources: pa.Array, lengths: pa.Array) -> list[pa.Array]:
        n = len(texts)
        if model is None or not n:
            return [pa.array(np.ones(n))] * 3 + [pa.array(np.ones(n, dtype=bool))]
        meta = zip(langs.to_pylist(), sources.to_pylist(), lengths.to_pylist(), strict=True)
        scores = model.scores(
            np.stack([text_features(t.as_py()) for t in texts]).astype(np.float64),
            np.stack([meta_features(*m) for m in meta]).astype(np.float64),
        )
        return [*(pa.array(x) for x in scores), pa.array(scores[2] >= model.threshold)]

    fields = [T.StructField(n, T.DoubleType()) for n in names[:3]] + [T.StructField(names[3], T.BooleanType())]
    return appended(frame, ["text", "lang", "source", "n_chars"], fields, work)


def score_documents(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) of every row."""
    rows = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
    return _scored(rows, [*SCORES, "kept"], model).select("doc_id", *SCORES, "kept")


def keep_by_classifier(docs: DataFrame, labels: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs``, with their columns, that ``quality_classifier`` keeps; nothing is shuffled."""
    model = fit_on(docs if training is None else training, labels)
    names = free_names(docs, *SCORES, "kept")
    return _scored(docs, names, model).where(F.col(names[3])).select(*columns_of(docs))


def quality_classifier(docs: DataFrame, labels: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) of every document of ``docs``.

    The model is fitted on bounded samples of ``training`` (by default ``docs``) and ``labels``
    (doc_id, quality 0 or 1), then scores every whole text. Scores are calibrated probabilities
    of good quality; ``kept`` follows a threshold that keeps ``KEEP_GOOD`` of the held-out good
    rows. With no usable labels, or of one class only, every row has score 1 and is kept. Null
    texts and metadata count as empty; repeated rows stay; an empty table gives no rows; other
    columns are ignored.
    """
    return score_documents(docs, fit_on(docs if training is None else training, labels))
