import ast
import importlib
import pathlib

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from bugsieve.llm import cotraining, passages, rules, simhash
from bugsieve.llm.common import saved

ROOT = pathlib.Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    quality = {r.doc_id: r.quality for r in labels.collect()}
    sizes = [len(before)]
    given = docs
    made = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = saved(stage(spark, given, SF), name)
        assert given.columns == columns
        made[name] = {r.doc_id: r for r in given.collect()}
        sizes.append(len(made[name]))
    assert sizes == sorted(sizes, reverse=True)
    wanted = {r.doc_id for r in rules.quality_rules(docs, labels).where("kept").collect()}
    assert set(made["quality_rules"]) == wanted
    assert {i for i in made["quality_classifier"] if i in quality} >= {i for i in wanted if quality.get(i) == 1}
    assert not {i for i in made["quality_classifier"] if quality.get(i) == 0}
    ids = sorted(made["quality_classifier"])
    texts = [(before[i] or "").encode() for i in ids]
    fps = [simhash.fingerprint_of(t) & (2**64 - 1) for t in texts]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = sorted((find(ids[a]), find(ids[b])))
                parent[y] = x
    assert set(made["near_duplicates"]) == {find(i) for i in ids}
    cut = made["repeated_passages"]
    assert set(cut) == set(made["near_duplicates"])
    lines = {}
    for i in sorted(cut):
        for line in before[i].split("\n"):
            if len(line.split()) > 50:
                lines.setdefault(line, []).append(i)
    for line, where in lines.items():
        assert sum(line in cut[i].text for i in set(where)) <= 1
    assert any(len(set(where)) > 1 for where in lines.values())
    assert all(cut[i].n_chars == len(cut[i].text) for i in cut if cut[i].text != before[i])
    pieces = corpus_pipeline.STAGES[-1][1](spark, given, SF).toPandas()
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    total = pieces.groupby("doc_id").length.sum().to_dict()
    assert total == {i: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in cut.items()}


def test_run_equals_the_stages(spark, small):
    rows = corpus_pipeline.run(spark, small).toPandas()
    given = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        given = saved(stage(spark, given, small), name)
    by_doc = [f.groupby("doc_id").length.sum().to_dict() for f in (rows, given.toPandas())]
    assert by_doc[0] == by_doc[1] and by_doc[0]


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if "quality" not in s[0]], ids=lambda s: s[0])
def test_odd_tables(spark, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", None, "", 0), (1, "", None, "", 0), (2, "x " * 50_000, "en", "s", 100_000), (None, "x", "a", "b", 1)]
    assert stage[1](spark, spark.createDataFrame(rows, schema), SF).count() >= 3
    assert stage[1](spark, spark.createDataFrame([], schema), SF).count() == 0


def test_nothing_else_imports_the_package():
    for path in ROOT.glob("bugsieve/**/*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else []
            names += [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(".llm" in n for n in names), path


def test_entry_registers_the_queries():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert set(entry.oracle_sql()) <= set(names)
    assert cotraining and passages
