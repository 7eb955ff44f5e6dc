import numpy as np

from bugsieve.llm import cotraining

SF = "/root/testdata/sf0.01"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    train, test = labels.where("pmod(hash(doc_id), 2) = 0"), labels.where("pmod(hash(doc_id), 2) = 1")
    judged = cotraining.quality_classifier(docs, train).join(test, "doc_id").collect()
    good = [r.kept for r in judged if r.quality == 1]
    bad = [r.kept for r in judged if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_odd_rows_and_columns(spark):
    docs, labels = tables(spark)
    extra = [(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, "word " * 40_000, None, "s", -5), (0, "again", "en", "s", 5)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).selectExpr("*", "1 AS score", "'k' AS kept")
    labels = labels.unionByName(spark.createDataFrame([(None, 0, 0), (3, None, 1), (-1, 0, 0)], labels.schema))
    rows = cotraining.quality_classifier(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= x <= 1 for r in rows for x in (r.text_score, r.meta_score, r.score))
    kept = cotraining.keep_by_classifier(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.kept)


def test_without_usable_labels(spark):
    docs, labels = tables(spark)
    for some in (labels.limit(0), labels.where("quality = 1")):
        assert cotraining.quality_classifier(docs, some).where("kept AND score = 1").count() == docs.count()
    assert cotraining.quality_classifier(docs.limit(0), labels).count() == 0


def test_views_teach_each_other():
    rng = np.random.default_rng(3)
    n = 4_000
    y = rng.integers(0, 2, n)
    text = rng.normal(size=(n, 6)) + 3 * y[:, None] * (np.arange(6) < 2)
    meta = rng.normal(size=(n, 6)) + 3 * y[:, None] * (np.arange(6) < 2)
    known, pool, test = slice(0, 40), slice(40, 2_000), slice(2_000, n)
    model = cotraining.co_train(text[known], meta[known], y[known], text[pool], meta[pool])
    both = model.scores(text[test], meta[test])
    right = [((p > 0.5) == y[test]).mean() for p in both]
    assert min(right[:2]) > 0.93 and right[2] > 0.97
