"""The registered queries: one per operator, over whole tables, with reference SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import bugsieve as bs
from bugsieve.functions import scoring
from bugsieve.functions import text as tx
from bugsieve.functions.rules import Rule, default_rules, rules_df
from bugsieve.operators.validate import violations
from bugsieve.schema import FIELDS, RECORD
from bugsieve.sources.scratch import scratch_dir
from bugsieve.sources.staging import metadata
from checks import corpus
from checks import oracle as o

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def md5(c: str | Column) -> Column:
    return F.md5(F.col(c) if isinstance(c, str) else c)


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def records(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Records of the log corpus with their key."""
    return bs.normalize(corpus.logs(spark, sf_dir), keep=["event_id"], **options)


def flat_record() -> list[Column]:
    cols = []
    for f in FIELDS:
        cols += [
            F.col(f"{f}.value").alias(f"{f}_value"),
            r6(f"{f}.confidence").alias(f"{f}_confidence"),
            F.col(f"{f}.source").alias(f"{f}_source"),
            F.col(f"{f}.raw_evidence").alias(f"{f}_evidence"),
        ]
    return cols


# --- sources -------------------------------------------------------------------------------

MAX_FILE_MB = 0.5


def _read_back(staging: DataFrame) -> list[Column]:
    meta = F.col("source_metadata")
    return [
        meta["source_type"].alias("source_type"),
        meta["file_size_bytes"].alias("file_size_bytes"),
        meta["raw_text_length"].alias("raw_text_length"),
        md5("text").alias("text_md5"),
        "reject_reason",
    ]


# Every line is read: files of 2,048 and 4,096 lines stay below the size limit, so that their number is
# the data's size over a file's, and
# all files of every second block of lines, short and long, have CR LF line ends and bytes that are
# not UTF-8. Oversize files hold lines of their own, and some files have zero bytes.
BLOCK_LINES, SHORT_LINES, OVERSIZE_BLOCKS, EMPTY_FILES = 6_144, 2_048, 8, 3
_PART = f"CAST(4 * floor(event_id / {BLOCK_LINES}) + CASE WHEN event_id % {BLOCK_LINES} < {SHORT_LINES} THEN 0 ELSE 1 END AS BIGINT)"
_OVERSIZE = (
    f"CAST(4 * floor(event_id / {BLOCK_LINES}) + 2 AS BIGINT)", "repeat('oversize ', 70000)",
    f"event_id % {BLOCK_LINES * OVERSIZE_BLOCKS} = 0",
)
_CR_LF = "floor(chunk / 4) % 2 = 0"


def _write_all_lines(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "all-lines")
    number, extra, few = _OVERSIZE
    lines = corpus.log_lines(spark, sf_dir)
    parts = lines.selectExpr(f"{_PART} AS chunk", "event_id", "line").unionByName(
        lines.where(few).selectExpr(f"{number} AS chunk", "event_id", f"{extra} AS line")
    )
    line = f"CASE WHEN {_CR_LF} THEN CAST(concat(encode(line, 'UTF-8'), X'FF0D') AS STRING) ELSE line END"
    (
        parts.repartition("chunk").sortWithinPartitions("chunk", "event_id")
        .selectExpr("chunk", f"{line} AS line").write.partitionBy("chunk").text(path)
    )
    for i in range(EMPTY_FILES):
        spark.createDataFrame([], "line string").write.text(f"{path}/chunk={-1 - i}")
    return path


_ALL_LINES_SQL = (
    "SELECT chunk, 'error_log' AS source_type, size AS file_size_bytes, "
    f"CASE WHEN size <= {int(MAX_FILE_MB * 1024 * 1024)} THEN length(text) END AS raw_text_length, "
    f"CASE WHEN size <= {int(MAX_FILE_MB * 1024 * 1024)} THEN md5(text) END AS text_md5, "
    f"CASE WHEN size > {int(MAX_FILE_MB * 1024 * 1024)} THEN printf('File size (%.2f MB) exceeds maximum allowed ({MAX_FILE_MB} MB)', "
    "size / 1048576.0::DOUBLE) END AS reject_reason "
    f"FROM (SELECT *, strlen(text) + CASE WHEN {_CR_LF} THEN 2 * lines ELSE 0 END AS size FROM ("
    f"SELECT {_PART} AS chunk, string_agg({corpus.LOG_LINE}, chr(10) ORDER BY event_id) || chr(10) AS text, "
    "count(*) AS lines FROM events GROUP BY 1 UNION ALL "
    f"SELECT {_OVERSIZE[0]}, {_OVERSIZE[1]} || chr(10), 1 FROM events WHERE {_OVERSIZE[2]}))"
)


_ALL_FILES_SQL = f"{_ALL_LINES_SQL} UNION ALL SELECT NULL, 'error_log', 0, 0, md5(''), NULL FROM range({EMPTY_FILES})"


@register("s1_read_all_lines", _ALL_FILES_SQL)
@register("s1_read_error_logs", _ALL_FILES_SQL)
def s1(spark, sf_dir):
    staging = bs.read_error_logs(spark, _write_all_lines(spark, sf_dir), max_mb=MAX_FILE_MB)
    return staging.select(F.col("chunk").cast("bigint").alias("chunk"), *_read_back(staging))


# A folder of turns as files of some 250 KB, named by block and kind; the tasks write the names.
_BLOCK_TALKS = 400
_KINDS = ("log", "txt", "LOG", "Txt", "pdf", "Doc", "docx", "csv", "json", "tar.gz")


def _named_files(kinds: int) -> str:
    """(name, kind, text): the turns of each file, in the SQL of both engines."""
    cases = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS[:kinds]))
    block = f"CAST(floor(conv_id / {_BLOCK_TALKS}) AS BIGINT)"
    return f"CONCAT('talks ', {block}, '%-', conv_id % {kinds}, '.', CASE conv_id % {kinds} {cases} END)"


def _files_sql(kinds: int) -> str:
    return (
        f"SELECT name, regexp_extract(name, '[.]([^.]+)$', 1) AS kind, strlen(text) AS size, text FROM (SELECT "
        f"{_named_files(kinds)} AS name, string_agg({corpus.FREE_TEXT}, chr(10) ORDER BY conv_id, turn) || chr(10) AS text "
        "FROM conversations GROUP BY 1)"
    )


def _write_folder(spark: SparkSession, sf_dir: str, name: str, kinds: int) -> str:
    path = scratch_dir(spark, name)
    turns = corpus.free_texts(spark, sf_dir).select(
        F.expr(_named_files(kinds)).alias("name"), F.struct("conv_id", "turn", "text").alias("t")
    )
    texts = turns.groupBy("name").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "name", F.concat(F.array_join("t.text", "\n"), F.lit("\n")).alias("text")
    )
    corpus.write_files(texts, path)
    return path


@register(
    "s4_scan_directory",
    "SELECT name AS file_name, 'error_log' AS source_type, size AS file_size_bytes, length(text) AS raw_text_length, "
    f"md5(text) AS text_md5, NULL AS reject_reason FROM ({_files_sql(4)}) WHERE kind IN ('log', 'txt')",
)
def s4(spark, sf_dir):
    """Lower-case log and text files only, next to others."""
    staging = bs.scan_directory(spark, _write_folder(spark, sf_dir, "folder", 4))
    return staging.select(F.col("source_metadata.file_name").alias("file_name"), *_read_back(staging))


@register(
    "s7_read_folder",
    "SELECT name AS file_name, 'error_log' AS source_type, size AS file_size_bytes, length(text) AS raw_text_length, "
    "md5(text) AS text_md5, CASE WHEN text IS NULL THEN 'Unsupported file type: .' || kind END AS reject_reason FROM ("
    "SELECT name, kind, size, CASE WHEN lower(kind) IN ('log', 'txt') THEN text "
    "WHEN lower(kind) = 'pdf' THEN '[PDF content from ' || name || ']' "
    f"WHEN lower(kind) IN ('doc', 'docx') THEN '[DOC content from ' || name || ']' END AS text FROM ({_files_sql(10)}))",
)
def s7_folder(spark, sf_dir):
    """Logs, documents and files of other types: a row for each."""
    found = bs.read_folder(spark, _write_folder(spark, sf_dir, "mixed 100%", 10), recursive=True)
    return found.select(F.col("source_metadata.file_name").alias("file_name"), *_read_back(found))


# Twelve paths for each block: ten files that are there, or are for some blocks, and two that never are.
@register(
    "s6_check_paths",
    "WITH blocks AS (SELECT DISTINCT CAST(floor(conv_id / 400) AS BIGINT) AS b FROM conversations), asked AS ("
    + " UNION ALL ".join(
        f"SELECT 'talks ' || b || '%-{i}.{k}' AS name FROM blocks"
        for i, k in [*enumerate(_KINDS), (10, "log"), (11, "md")]
    )
    + f") SELECT asked.name, size AS length, CASE WHEN size IS NULL THEN 'File not found: ' || asked.name "
    "WHEN lower(regexp_extract(asked.name, '[.]([^.]+)$', 1)) NOT IN ('log', 'txt', 'pdf', 'doc', 'docx') "
    "THEN 'Unsupported file type: .' || regexp_extract(asked.name, '[.]([^.]+)$', 1) END AS reject_reason "
    f"FROM asked LEFT JOIN ({_files_sql(10)}) f ON f.name = asked.name",
)
def s6_check_paths(spark, sf_dir):
    path = _write_folder(spark, sf_dir, "asked", 10)
    blocks = corpus.free_texts(spark, sf_dir).selectExpr(f"CAST(floor(conv_id / {_BLOCK_TALKS}) AS BIGINT) AS b").distinct()
    names = [f"CONCAT('talks ', b, '%-{i}.{k}')" for i, k in [*enumerate(_KINDS), (10, "log"), (11, "md")]]
    asked = blocks.selectExpr(f"explode(array({', '.join(names)})) AS name").withColumn(
        "path", F.concat(F.lit(f"{path}/"), "name")
    )
    reason = F.replace("reject_reason", F.lit(f"{path}/"), F.lit(""))
    return bs.check_paths(asked).select("name", "length", reason.alias("reject_reason"))


@register(
    "s2_read_freetext",
    f"SELECT conv_id, turn, text, length(text) AS raw_text_length, reject_reason FROM ({o.FREE_CLEAN})",
)
def s2(spark, sf_dir):
    staging = bs.read_freetext(corpus.free_texts(spark, sf_dir), keep=("conv_id", "turn"))
    return staging.select(
        "conv_id", "turn", "text",
        F.col("source_metadata.raw_text_length").alias("raw_text_length"), "reject_reason",
    )


@register(
    "s3_read_ado",
    "SELECT o_orderkey, text, source_id, length(text) AS raw_text_length, reject_reason "
    f"FROM ({o.ITEMS})",
)
def s3(spark, sf_dir):
    staging = bs.read_ado(corpus.work_items(spark, sf_dir), keep=("o_orderkey",))
    return staging.select(
        "o_orderkey", "text", F.col("source_metadata.source_id").alias("source_id"),
        F.col("source_metadata.raw_text_length").alias("raw_text_length"), "reject_reason",
    )


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bs.union_sources(
        corpus.logs(spark, sf_dir).select("text", "source_metadata"),
        bs.read_freetext(corpus.free_texts(spark, sf_dir)),
        bs.read_ado(corpus.work_items(spark, sf_dir)),
    )


@register(
    "s5_union_sources",
    "SELECT source_type, md5(text) AS text_md5, length(text) AS raw_text_length, reject_reason FROM ("
    f"SELECT 'error_log' AS source_type, text, NULL AS reject_reason FROM ({o.LOGS}) UNION ALL "
    f"SELECT 'freetext', text, reject_reason FROM ({o.FREE_CLEAN}) UNION ALL "
    f"SELECT 'ado_bug', text, reject_reason FROM ({o.ITEMS}))",
)
def s5(spark, sf_dir):
    return mixed(spark, sf_dir).select(
        F.col("source_metadata.source_type").alias("source_type"), md5("text").alias("text_md5"),
        F.col("source_metadata.raw_text_length").alias("raw_text_length"), "reject_reason",
    )


_SUFFIX_SQL = r"regexp_extract(regexp_extract(path, '[^/]*$'), '^.+(\.[^.]+)$', 1)"
_FILE_REASON_SQL = (
    "CASE WHEN length IS NULL THEN 'File not found: ' || path "
    f"WHEN lower({_SUFFIX_SQL}) NOT IN ('.txt', '.log', '.pdf', '.doc', '.docx') "
    f"THEN 'Unsupported file type: ' || {_SUFFIX_SQL} "
    "WHEN length > 52428800 THEN printf('File size (%.2f MB) exceeds maximum allowed (50 MB)', "
    "length / 1048576.0::DOUBLE) END"
)
_MANIFEST_SQL = (
    f"SELECT o_orderkey, {corpus.FILE_PATH} AS path, {corpus.FILE_SIZE} AS length FROM orders"
)


@register(
    "s6_reject_invalid",
    "SELECT 'file' AS input, o_orderkey AS item, reason FROM "
    f"(SELECT *, {_FILE_REASON_SQL} AS reason FROM ({_MANIFEST_SQL})) WHERE reason IS NOT NULL UNION ALL "
    "SELECT 'document', doc_id, 'Text length (' || length(text) || ') exceeds maximum (10000)' "
    "FROM documents WHERE length(text) > 10000 UNION ALL "
    f"SELECT 'work item', o_orderkey, reject_reason FROM ({o.ITEMS}) WHERE reject_reason IS NOT NULL",
)
def s6(spark, sf_dir):
    def bad(df: DataFrame, name: str, key: str) -> DataFrame:
        return df.where(F.col("reject_reason").isNotNull()).select(
            F.lit(name).alias("input"), F.col(key).alias("item"), F.col("reject_reason").alias("reason")
        )

    files = bad(bs.check_manifest(corpus.manifest(spark, sf_dir)), "file", "o_orderkey")
    documents = bs.read_freetext(corpus.table(spark, sf_dir, "documents"), keep=("doc_id",))
    items = bs.read_ado(corpus.work_items(spark, sf_dir), keep=("o_orderkey",))
    return files.unionByName(bad(documents, "document", "doc_id")).unionByName(
        bad(items, "work item", "o_orderkey")
    )


@register(
    "s6_missing_files",
    "SELECT path AS source_id, 'File not found: ' || path AS reject_reason "
    f"FROM ({_MANIFEST_SQL}) WHERE length IS NULL",
)
def s6_missing(spark, sf_dir):
    manifest = corpus.manifest(spark, sf_dir)
    found = manifest.where(F.col("length").isNotNull()).select(
        F.lit("").alias("text"), metadata("error_log", F.col("path"), F.lit("")).alias("source_metadata")
    )
    return bs.missing_files(manifest.select("path"), found).select("source_id", "reject_reason")


@register(
    "s7_binary_doc_placeholder",
    "SELECT o_orderkey, text, length(text) AS raw_text_length, length AS file_size_bytes, "
    f"reason AS reject_reason FROM (SELECT *, {_FILE_REASON_SQL} AS reason, "
    f"CASE lower({_SUFFIX_SQL}) WHEN '.pdf' THEN '[PDF content from ' ELSE '[DOC content from ' END || "
    "regexp_extract(path, '[^/]*$') || ']' AS text "
    f"FROM ({_MANIFEST_SQL})) WHERE lower({_SUFFIX_SQL}) IN ('.pdf', '.doc', '.docx') AND length IS NOT NULL",
)
def s7(spark, sf_dir):
    present = corpus.manifest(spark, sf_dir).where(F.col("length").isNotNull())
    return bs.document_placeholders(present).select(
        "o_orderkey", "text", F.col("source_metadata.raw_text_length").alias("raw_text_length"),
        F.col("source_metadata.file_size_bytes").alias("file_size_bytes"), "reject_reason",
    )


# --- sinks ---------------------------------------------------------------------------------

_JSON_KEYS = (
    "bug_id schema_version source_metadata " + " ".join(FIELDS)
    + " severity environment failure_classification overall_confidence fields_extracted_by_regex"
    " fields_enriched_by_nlp total_extractable_fields processing_timestamp nlp_enrichment_applied"
).split()


@register(
    "k1_write_normalized_json",
    o.with_records(
        o.LOGS,
        f"SELECT 'log_' || k AS source_id, '{','.join(_JSON_KEYS)}' AS json_keys, "
        "true AS severity_is_null, error_type_value, round(overall_confidence, 6) AS overall_confidence, "
        "fields_extracted_by_regex FROM rec",
    ),
)
def k1(spark, sf_dir):
    out = scratch_dir(spark, "json")
    bs.write_bugs(bs.normalize(corpus.logs(spark, sf_dir)), out)
    line = F.col("value")
    return spark.read.text(out).select(
        F.get_json_object(line, "$.source_metadata.source_id").alias("source_id"),
        F.array_join(F.json_object_keys(line), ",").alias("json_keys"),
        F.contains(line, F.lit('"severity":null')).alias("severity_is_null"),
        F.get_json_object(line, "$.error_type.value").alias("error_type_value"),
        r6(F.get_json_object(line, "$.overall_confidence").cast("double")).alias("overall_confidence"),
        F.get_json_object(line, "$.fields_extracted_by_regex").cast("int").alias("fields_extracted_by_regex"),
    )


def _shown_sql(f: str) -> str:
    value = f"{f}_value"
    if f not in ("error_type", "component_module"):
        value = f"CASE WHEN length({value}) > 100 THEN substring({value}, 1, 100) || '...' ELSE {value} END"
    return f"coalesce({value}, '[NOT DETECTED]') AS {f}"


@register(
    "k2_bug_summary",
    o.with_records(
        o.LOGS,
        "SELECT 'log_' || k AS source_file, round(overall_confidence, 6) AS overall_confidence, "
        "fields_extracted_by_regex || '/5' AS fields_extracted, "
        + ", ".join(_shown_sql(f) for f in FIELDS)
        + f", {o.low_fields('0.6')} AS low_confidence_fields FROM rec",
    ),
)
def k2(spark, sf_dir):
    return bs.bug_summary(records(spark, sf_dir)).select(
        "source_file", r6("overall_confidence").alias("overall_confidence"), "fields_extracted",
        *FIELDS, "low_confidence_fields",
    )


# --- text ----------------------------------------------------------------------------------

# White space and unprintable characters around and inside each document.
_DIRTY = "'   ' || text || '​' || chr(7) || chr(13) || chr(9) || 'x' || chr(1) || '　' || chr(10)"


@register(
    "c1_clean_freetext",
    f"SELECT doc_id, md5(t) AS text_md5, length(t) AS n FROM (SELECT doc_id, {o.clean('d')} AS t "
    f"FROM (SELECT doc_id, {_DIRTY} AS d FROM documents))",
)
def c1(spark, sf_dir):
    dirty = corpus.table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_DIRTY} AS d")
    return dirty.select("doc_id", tx.clean_freetext(F.col("d")).alias("t")).select(
        "doc_id", md5("t").alias("text_md5"), F.length("t").alias("n")
    )


@register(
    "c2_strip_html",
    f"SELECT page_id, md5(t) AS text_md5, length(t) AS n FROM (SELECT page_id, {o.strip_html('html')} AS t FROM pages)",
)
def c2(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.strip_html(F.col("html")).alias("t")).select(
        "page_id", md5("t").alias("text_md5"), F.length("t").alias("n")
    )


@register("c3_compose_work_item", f"SELECT o_orderkey, composed FROM ({o.COMPOSED})")
def c3(spark, sf_dir):
    names = ["title", "description", "repro", "criteria"]
    entries = []
    for (key, _), name in zip(tx.WORK_ITEM_PARTS, names):
        entries += [F.lit(key), F.col(name)]
    return corpus.item_parts(spark, sf_dir).select(
        "o_orderkey", tx.compose_work_item(F.create_map(*entries)).alias("composed")
    )


_ANY_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@register(
    "c4_sanitize_text",
    "SELECT doc_id, md5(t) AS text_md5, length(t) AS n FROM (SELECT doc_id, "
    f"trim(regexp_replace(replace(substring(d, 1, 100000), chr(0), ''), '{_ANY_SPACE}', ' ', 'g'), ' ') AS t "
    f"FROM (SELECT doc_id, {_DIRTY} AS d FROM documents))",
)
def c4(spark, sf_dir):
    dirty = corpus.table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_DIRTY} AS d")
    return dirty.select("doc_id", tx.sanitize_text(F.col("d")).alias("t")).select(
        "doc_id", md5("t").alias("text_md5"), F.length("t").alias("n")
    )


# Each document with a contact line made from its number, so that all four kinds occur.
_CONTACT = (
    "text || chr(10) || 'call 555-' || lpad(CAST(doc_id % 1000 AS STRING), 3, '0') || '-4821 or mail u' || "
    "CAST(doc_id AS STRING) || '@example.org, id 123-45-' || lpad(CAST(doc_id % 10000 AS STRING), 4, '0') || "
    "', card 4111 1111-1111 ' || lpad(CAST(doc_id % 10000 AS STRING), 4, '0') || '.'"
)


@register(
    "c5_redact_pii",
    f"SELECT doc_id, md5(t) AS text_md5, length(t) AS n FROM (SELECT doc_id, {o.redact('d')} AS t "
    f"FROM (SELECT doc_id, {_CONTACT} AS d FROM documents))",
)
def c5(spark, sf_dir):
    documents = corpus.table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_CONTACT} AS d")
    return documents.select("doc_id", tx.redact_pii(F.col("d")).alias("t")).select(
        "doc_id", md5("t").alias("text_md5"), F.length("t").alias("n")
    )


@register(
    "c6_flag_unsafe_paths",
    f"SELECT o_orderkey, path, list_extract({corpus.PATH_SAFE}, "
    f"CAST(o_orderkey % {len(corpus.PATH_SAFE)} + 1 AS BIGINT)) AS safe FROM ({_MANIFEST_SQL})",
)
def c6(spark, sf_dir):
    return corpus.manifest(spark, sf_dir).select(
        "o_orderkey", "path", tx.flag_unsafe_paths(F.col("path"), "/data").alias("safe")
    )


# A value that occurs in the text (its second line, else its first word) or does not.
_NEEDLE = (
    "CASE event_id % 4 WHEN 0 THEN 'not in the text at all ' || repeat('x', 300) "
    "WHEN 1 THEN substring(text, 30, 60) WHEN 2 THEN substring(text, 1, 5) ELSE text END"
)


@register(
    "c7_evidence_window",
    f"SELECT event_id, {o.short_evidence('window_text')} AS evidence FROM (SELECT event_id, {o._WINDOW} AS window_text "
    f"FROM (SELECT event_id, text, value, strpos(text, value) AS place FROM (SELECT event_id, text, {_NEEDLE} AS value FROM ({o.LOGS}))))",
)
def c7(spark, sf_dir):
    df = corpus.logs(spark, sf_dir).selectExpr("event_id", "text", f"{_NEEDLE} AS value")
    return df.select("event_id", tx.evidence_window(F.col("text"), F.col("value")).alias("evidence"))


@register(
    "c8_truncate_value",
    f"SELECT doc_id, md5(t) AS text_md5, length(t) AS n FROM (SELECT doc_id, {o.truncated('text')} AS t FROM documents)",
)
def c8(spark, sf_dir):
    documents = corpus.table(spark, sf_dir, "documents")
    return documents.select("doc_id", tx.truncate_value(F.col("text")).alias("t")).select(
        "doc_id", md5("t").alias("text_md5"), F.length("t").alias("n")
    )


# --- extraction ----------------------------------------------------------------------------

_RULE_VALUES = ", ".join(
    f"('{r.rule_id}', '{r.field}', '{r.tier}', CAST({r.base} AS DOUBLE))" for r in default_rules()
)


def _log_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bs.rule_hits(corpus.logs(spark, sf_dir).select("event_id", "text"))


@register(
    "x1_rule_table",
    f"WITH {o.hits_cte(o.LOGS)} SELECT t.rule_id, t.field, t.tier, t.base, count(hits.k) AS texts_hit, "
    f"coalesce(sum(hits.matches), 0)::BIGINT AS matches FROM (VALUES {_RULE_VALUES}) t(rule_id, field, tier, base) "
    "LEFT JOIN hits ON hits.rule_id = t.rule_id GROUP BY ALL",
)
def x1(spark, sf_dir):
    used = (
        _log_hits(spark, sf_dir)
        .groupBy("rule_id")
        .agg(F.count(F.lit(1)).alias("texts_hit"), F.sum("matches").alias("matches"))
    )
    return (
        rules_df(spark)
        .join(used, "rule_id", "left")
        .select(
            "rule_id", "field", "tier", "base",
            F.coalesce("texts_hit", F.lit(0)).alias("texts_hit"),
            F.coalesce("matches", F.lit(0)).alias("matches"),
        )
    )


@register(
    "x2_rule_hits",
    f"WITH {o.hits_cte(o.LOGS)} SELECT k AS event_id, rule_id, value, matches FROM hits",
)
def x2(spark, sf_dir):
    return _log_hits(spark, sf_dir).select("event_id", "rule_id", "value", "matches")


@register(
    "x3_occurrence_boost",
    f"WITH {o.hits_cte(o.LOGS)} SELECT rule_id, matches, round(confidence, 6) AS confidence, count(*) AS texts "
    "FROM hits GROUP BY ALL",
)
def x3(spark, sf_dir):
    return (
        _log_hits(spark, sf_dir)
        .groupBy("rule_id", "matches", r6("confidence").alias("confidence"))
        .agg(F.count(F.lit(1)).alias("texts"))
    )


@register(
    "x4_best_in_tier",
    f"WITH {o.hits_cte(o.LOGS)}, {o.BEST} SELECT k AS event_id, field, tier, rule_id, value, "
    "round(confidence, 6) AS confidence FROM best",
)
def x4(spark, sf_dir):
    return bs.best_in_tier(_log_hits(spark, sf_dir), ["event_id"]).select(
        "event_id", "field", "tier", "rule_id", "value", r6("confidence").alias("confidence")
    )


@register(
    "x5_strict_then_loose",
    f"WITH {o.hits_cte(o.LOGS)}, {o.BEST} SELECT src.k AS event_id, f.field, won.rule_id, won.value, "
    "'regex_' || won.tier AS source, round(won.confidence, 6) AS confidence FROM src "
    f"CROSS JOIN (VALUES {', '.join(f'({o.quote(f)})' for f in FIELDS)}) f(field) "
    "LEFT JOIN won ON won.k = src.k AND won.field = f.field",
)
def x5(spark, sf_dir):
    found = bs.extract_all_fields(corpus.logs(spark, sf_dir).select("event_id", "text"))
    parts = [
        F.struct(
            F.lit(f).alias("field"), F.col(f)["rule_id"].alias("rule_id"), F.col(f)["value"].alias("value"),
            F.col(f)["source"].alias("source"), r6(F.col(f)["raw_confidence"]).alias("confidence"),
        )
        for f in FIELDS
    ]
    return found.select("event_id", F.inline(F.array(*parts)))


def _fields_sql(f: str) -> str:
    return ", ".join(
        f"max(CASE WHEN field = '{f}' THEN {c} END) AS {f}_{name}"
        for name, c in [("value", "value"), ("rule", "rule_id"), ("evidence", "evidence")]
    )


@register(
    "x6_extract_all_fields",
    f"WITH {o.hits_cte(o.FREE_CLEAN.replace('SELECT conv_id, turn,', 'SELECT conv_id * 1000 + turn AS k, conv_id, turn,', 1))}, "
    f"{o.BEST}, {o.FIELD_ROWS} SELECT src.conv_id, src.turn, {', '.join(_fields_sql(f) for f in FIELDS)} "
    "FROM src LEFT JOIN scored USING (k) WHERE src.reject_reason IS NULL GROUP BY src.conv_id, src.turn",
)
def x6(spark, sf_dir):
    staging = bs.read_freetext(corpus.free_texts(spark, sf_dir), keep=("conv_id", "turn"))
    good, _ = bs.split_rejects(staging)
    cols = []
    for f in FIELDS:
        cols += [
            F.col(f"{f}.value").alias(f"{f}_value"),
            F.col(f"{f}.rule_id").alias(f"{f}_rule"),
            F.col(f"{f}.raw_evidence").alias(f"{f}_evidence"),
        ]
    return bs.extract_all_fields(good.select("conv_id", "turn", "text")).select("conv_id", "turn", *cols)


@register(
    "x7_registry_counts",
    f"WITH {o.hits_cte(o.LOGS)}, rules(rule_id, field, tier, base) AS (VALUES {_RULE_VALUES}), "
    "fired AS (SELECT DISTINCT rule_id FROM hits) SELECT field, "
    "count(CASE WHEN tier = 'strict' THEN 1 END) AS strict, count(CASE WHEN tier = 'loose' THEN 1 END) AS loose, "
    "count(CASE WHEN tier = 'strict' AND fired.rule_id IS NOT NULL THEN 1 END) AS strict_fired, "
    "count(CASE WHEN tier = 'loose' AND fired.rule_id IS NOT NULL THEN 1 END) AS loose_fired "
    "FROM rules LEFT JOIN fired USING (rule_id) GROUP BY field",
)
def x7(spark, sf_dir):
    fired = (
        _log_hits(spark, sf_dir).groupBy("field", "tier", "rule_id").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("field")
        .agg(
            F.count_if(F.col("tier") == "strict").alias("strict_fired"),
            F.count_if(F.col("tier") == "loose").alias("loose_fired"),
        )
    )
    return (
        bs.registry_counts(spark)
        .join(fired, "field", "left")
        .na.fill(0)
        .select("field", "strict", "loose", "strict_fired", "loose_fired")
    )


# --- scoring -------------------------------------------------------------------------------

_BASE = "CAST((l_orderkey * 7 + l_linenumber) % 101 AS DOUBLE) / 100"
_SOURCES = ["ado_api", "regex_strict", "rule_based", "regex_loose", "user_provided", "nlp_enriched", "other"]
_SOURCE_SQL = "CASE (l_orderkey + l_linenumber) % 7 " + " ".join(
    f"WHEN {i} THEN '{s}'" for i, s in enumerate(_SOURCES)
) + " END"
_HAS_EVIDENCE = "l_linenumber % 2 = 0"
_LENGTH = "CAST((l_orderkey + l_partkey) % 9 AS INT)"
_WEIGHT_SQL = "CASE source " + " ".join(
    f"WHEN '{s}' THEN CAST({w} AS DOUBLE)" for s, w in scoring.SOURCE_WEIGHTS.items()
) + " ELSE CAST(0.5 AS DOUBLE) END"
_LINE_CASES = (
    f"SELECT l_orderkey, l_linenumber, {_BASE} AS base, {_SOURCE_SQL} AS source, "
    f"{_HAS_EVIDENCE} AS has_evidence, {_LENGTH} AS value_length FROM lineitem"
)


# The exact scaled product as a sum p + e of two doubles; ties by the sign of e, then to even.
_EXACT_ROUND = (
    "(floor(p) + CASE WHEN p - floor(p) > 0.5 THEN 1 WHEN p - floor(p) < 0.5 THEN 0 "
    "WHEN e > 0 THEN 1 WHEN e < 0 THEN 0 ELSE floor(p)::BIGINT % 2 END) / 1000::DOUBLE"
)


@register(
    "f1_score_field",
    f"SELECT base, source, has_evidence, value_length, {_EXACT_ROUND} AS score, count(*) AS n FROM "
    "(SELECT *, (hi * 1000::DOUBLE - p) + (points - hi) * 1000::DOUBLE AS e FROM "
    "(SELECT *, points * 1000::DOUBLE AS p, points * 134217729::DOUBLE - (points * 134217729::DOUBLE - points) AS hi FROM "
    "(SELECT *, boosted * CASE WHEN value_length > 0 AND value_length < 5 THEN CAST(0.8 AS DOUBLE) "
    "ELSE CAST(1.0 AS DOUBLE) END AS points FROM (SELECT *, CASE WHEN has_evidence THEN "
    f"least(base * {_WEIGHT_SQL} + CAST(0.05 AS DOUBLE), CAST(1.0 AS DOUBLE)) ELSE base * {_WEIGHT_SQL} END AS boosted "
    f"FROM ({_LINE_CASES}))))) GROUP BY ALL",
)
def f1(spark, sf_dir):
    cases = corpus.table(spark, sf_dir, "lineitem").selectExpr(
        f"{_BASE} AS base", f"{_SOURCE_SQL} AS source", f"{_HAS_EVIDENCE} AS has_evidence",
        f"{_LENGTH} AS value_length",
    )
    score = scoring.score_field(
        F.col("base"), F.col("source"), F.col("has_evidence"), F.col("value_length")
    )
    return cases.groupBy("base", "source", "has_evidence", "value_length", score.alias("score")).agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "f2_confidence_level",
    o.with_records(
        o.LOGS,
        "SELECT k AS event_id, "
        + ", ".join(f"{o.level(f'{f}_confidence')} AS {f}_level" for f in FIELDS)
        + f", {o.level('round(overall_confidence, 9)')} AS overall_level FROM rec",
    ),
)
def f2(spark, sf_dir):
    return records(spark, sf_dir).select(
        "event_id",
        *[scoring.confidence_level(F.col(f"{f}.confidence")).alias(f"{f}_level") for f in FIELDS],
        scoring.confidence_level(F.round("overall_confidence", 9)).alias("overall_level"),
    )


@register(
    "f3_needs_enrichment",
    o.with_records(
        o.LOGS,
        "SELECT k AS event_id, "
        + ", ".join(
            f"{f}_confidence < 0.5 AS {f}_default, {f}_confidence < 0.5 AS {f}_at_zero, {f}_confidence < 0.9 AS {f}_at_09"
            for f in FIELDS
        )
        + " FROM rec",
    ),
)
def f3(spark, sf_dir):
    cols = []
    for f in FIELDS:
        c = F.col(f"{f}.confidence")
        cols += [
            scoring.needs_enrichment(c).alias(f"{f}_default"),
            scoring.needs_enrichment(c, 0).alias(f"{f}_at_zero"),
            scoring.needs_enrichment(c, 0.9).alias(f"{f}_at_09"),
        ]
    return records(spark, sf_dir).select("event_id", *cols)


@register(
    "f4_overall_confidence",
    o.with_records(o.LOGS, "SELECT k AS event_id, round(overall_confidence, 6) AS overall_confidence FROM rec"),
)
def f4(spark, sf_dir):
    return records(spark, sf_dir).select("event_id", r6("overall_confidence").alias("overall_confidence"))


@register(
    "f5_completeness",
    o.with_records(o.LOGS, f"SELECT k AS event_id, round(({o._FILLED}) / 5.0, 6) AS completeness FROM rec"),
)
def f5(spark, sf_dir):
    return records(spark, sf_dir).select("event_id", r6(scoring.completeness()).alias("completeness"))


@register(
    "f6_low_confidence_fields",
    o.with_records(
        o.LOGS,
        f"SELECT k AS event_id, {o.low_fields('0.5')} AS below_05, {o.low_fields('0.6')} AS below_06 FROM rec",
    ),
)
def f6(spark, sf_dir):
    return records(spark, sf_dir).select(
        "event_id",
        F.array_join(scoring.low_confidence_fields(0.5), ", ").alias("below_05"),
        F.array_join(scoring.low_confidence_fields(0.6), ", ").alias("below_06"),
    )


@register(
    "f7_regex_field_count",
    o.with_records(o.LOGS, "SELECT k AS event_id, fields_extracted_by_regex FROM rec"),
)
def f7(spark, sf_dir):
    return records(spark, sf_dir, enable_enrichment=True).select("event_id", "fields_extracted_by_regex")


# --- records -------------------------------------------------------------------------------


def _record_select(key_sql: str) -> str:
    return (
        f"SELECT {key_sql}, {o.RECORD_COLUMNS}, round(overall_confidence, 6) AS overall_confidence, "
        "fields_extracted_by_regex FROM rec"
    )


def _flat(df: DataFrame, *keys) -> DataFrame:
    return df.select(
        *keys, *flat_record(), r6("overall_confidence").alias("overall_confidence"),
        "fields_extracted_by_regex",
    )


@register("n1_normalize", o.with_records(o.LOGS, _record_select("k AS event_id")))
def n1(spark, sf_dir):
    return _flat(records(spark, sf_dir), "event_id")


_ITEMS_K = f"SELECT o_orderkey AS k, text, source_id FROM ({o.ITEMS}) WHERE reject_reason IS NULL"


@register("n1_normalize_ado", o.with_records(_ITEMS_K, _record_select("k AS o_orderkey")))
def n1_ado(spark, sf_dir):
    staging = bs.read_ado(corpus.work_items(spark, sf_dir), keep=("o_orderkey",))
    return _flat(bs.normalize(staging, keep=["o_orderkey"]), "o_orderkey")


@register(
    "n2_validate_record",
    o.with_records(
        o.LOGS,
        "SELECT event_id, array_to_string(list_filter(["
        "CASE WHEN event_id % 11 = 3 THEN 'source_metadata.source_type' END, "
        "CASE WHEN event_id % 13 = 5 THEN 'overall_confidence' END, "
        "CASE WHEN event_id % 7 = 1 THEN 'error_type.confidence' END, "
        "CASE WHEN event_id % 5 = 2 THEN 'component_module.source' END, "
        "CASE WHEN event_id % 3 = 0 AND expected_behavior_evidence IS NOT NULL THEN 'expected_behavior.raw_evidence' END"
        "], lambda p: p IS NOT NULL), ',') AS violations FROM (SELECT *, k AS event_id FROM rec)",
    ),
)
def n2(spark, sf_dir):
    k = F.col("event_id")

    def spoil(when: Column, column: str, field: str, value: Column) -> Column:
        c = F.col(column)
        return F.when(when, c.withField(field, value)).otherwise(c)

    spoiled = records(spark, sf_dir).withColumns(
        {
            "source_metadata": spoil(k % 11 == 3, "source_metadata", "source_type", F.lit("fax")),
            "overall_confidence": F.when(k % 13 == 5, F.lit(-0.1)).otherwise(F.col("overall_confidence")),
            "error_type": spoil(k % 7 == 1, "error_type", "confidence", F.lit(1.5)),
            "component_module": spoil(k % 5 == 2, "component_module", "source", F.lit("guess")),
            "expected_behavior": spoil(
                k % 3 == 0, "expected_behavior", "raw_evidence",
                F.rpad(F.col("expected_behavior.raw_evidence"), 501, "."),
            ),
        }
    )
    return spoiled.select("event_id", F.array_join(violations(), ",").alias("violations"))


# --- enrichment and plug-ins ---------------------------------------------------------------

_NEEDS_EXPECTED = "(expected_behavior_value IS NULL OR expected_behavior_confidence < 0.5) AND observed_behavior_value IS NOT NULL"


def _enriched_sql() -> str:
    e = "expected_behavior"
    others = ", ".join(f"{f}_value, {f}_confidence" for f in FIELDS if f != e)
    replaced = " + ".join(
        f"(CASE WHEN {f}_value IS NULL THEN 0.0 ELSE {f}_confidence END)" for f in FIELDS
    )
    return (
        "SELECT event_id, expected_behavior_value, round(expected_behavior_confidence, 6) AS expected_behavior_confidence, "
        "expected_behavior_source, expected_behavior_evidence, nlp_fields, applied, fields_extracted_by_regex, "
        f"round(({replaced}) / 5.0, 6) AS overall_confidence FROM (SELECT k AS event_id, {others}, "
        f"CASE WHEN {_NEEDS_EXPECTED} THEN '[NLP-inferred] System should not ' || observed_behavior_value ELSE {e}_value END AS {e}_value, "
        f"CASE WHEN {_NEEDS_EXPECTED} THEN 0.5 ELSE {e}_confidence END AS {e}_confidence, "
        f"CASE WHEN {_NEEDS_EXPECTED} THEN 'nlp_enriched' ELSE {e}_source END AS {e}_source, "
        f"CASE WHEN {_NEEDS_EXPECTED} THEN substring(text, 1, 500) ELSE {e}_evidence END AS {e}_evidence, "
        f"CASE WHEN {_NEEDS_EXPECTED} THEN 1 ELSE 0 END AS nlp_fields, {o.low_fields('0.5')} <> '' AS applied, "
        "fields_extracted_by_regex FROM rec)"
    )


@register("e1_enrich", o.with_records(o.LOGS, _enriched_sql()))
def e1(spark, sf_dir):
    e = F.col("expected_behavior")
    return records(spark, sf_dir, enable_enrichment=True).select(
        "event_id", e["value"].alias("expected_behavior_value"),
        r6(e["confidence"]).alias("expected_behavior_confidence"),
        e["source"].alias("expected_behavior_source"),
        e["raw_evidence"].alias("expected_behavior_evidence"),
        F.col("fields_enriched_by_nlp").alias("nlp_fields"),
        F.col("nlp_enrichment_applied").alias("applied"), "fields_extracted_by_regex",
        r6("overall_confidence").alias("overall_confidence"),
    )


@register(
    "e2_infer_expected",
    o.with_records(
        o.LOGS,
        "SELECT k AS event_id, CASE WHEN observed_behavior_value IS NOT NULL THEN "
        "'[NLP-inferred] System should not ' || observed_behavior_value END AS inferred FROM rec",
    ),
)
def e2(spark, sf_dir):
    inferred = bs.infer_expected(
        "expected_behavior", F.lit(None), F.col("observed_behavior.value"), F.lit(True)
    )
    return records(spark, sf_dir).select("event_id", inferred.alias("inferred"))


def _word_count(field: pd.Series, text: pd.Series, observed: pd.Series) -> pd.Series:
    return field + ": " + text.str.len().astype(str) + " characters"


@register(
    "u1_custom_enricher",
    o.with_records(
        o.LOGS,
        "SELECT k AS event_id, "
        + ", ".join(
            f"CASE WHEN {f}_value IS NULL OR {f}_confidence < 0.5 THEN '{f}: ' || length(text) || ' characters' "
            f"ELSE {f}_value END AS {f}"
            for f in FIELDS
        )
        + " FROM rec",
    ),
)
def u1(spark, sf_dir):
    bugs = records(spark, sf_dir, enable_enrichment=True, enricher=bs.vectorized_enricher(_word_count))
    return bugs.select("event_id", *[F.col(f"{f}.value").alias(f) for f in FIELDS])


_CUSTOM_RULES = [
    Rule("MY-1", "error_type", "strict", r"\[(\w+)\] (service\b[^\n]*)", "i", 0.8),
    Rule("MY-5", "error_type", "strict", r"(?P<sign_word>timeout|time out)[^\n]{0,40},", "i", 0.85, needs=(("TIME", "out"),)),
    Rule("MY-2", "error_type", "loose", r"[a-z]+ (?:failure|leak)[^\n]*", "i", 0.4),
    Rule("MY-3", "component_module", "strict", r"\[([a-z]+-[a-z]+)\]", "", 1.0),
    Rule("MY-4", "component_module", "strict", r"\[([a-z_0-9]+)\]", "", 0.9),
]


@register(
    "u2_custom_rules",
    o.with_records(
        o.LOGS,
        "SELECT k AS event_id, error_type_value, error_type_confidence, component_module_value, "
        "component_module_confidence, round(overall_confidence, 6) AS overall_confidence FROM rec",
        _CUSTOM_RULES,
    ),
)
def u2(spark, sf_dir):
    return records(spark, sf_dir, rules=_CUSTOM_RULES).select(
        "event_id", F.col("error_type.value").alias("error_type_value"),
        F.col("error_type.confidence").alias("error_type_confidence"),
        F.col("component_module.value").alias("component_module_value"),
        F.col("component_module.confidence").alias("component_module_confidence"),
        r6("overall_confidence").alias("overall_confidence"),
    )


# Any frame with the staging columns is a source, here supplier notes.
_NOTE = (
    "'supplier ' || s_name || ': ERROR [supply-' || CASE WHEN s_suppkey % 2 = 0 THEN 'east' ELSE 'west' END || "
    "'] failed to ship after ' || CAST(s_suppkey AS STRING) || ' attempts. Expected: delivery in two days'"
)


@register(
    "u3_custom_source",
    o.with_records(
        f"SELECT s_suppkey AS k, {_NOTE} AS text FROM supplier", _record_select("k AS s_suppkey")
    ),
)
def u3(spark, sf_dir):
    notes = corpus.table(spark, sf_dir, "supplier").selectExpr("s_suppkey", f"{_NOTE} AS text")
    staging = notes.select(
        "text",
        F.struct(
            F.lit("freetext").alias("source_type"),
            F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string")).alias("source_id"),
        ).alias("source_metadata"),
        "s_suppkey",
    )
    return _flat(bs.normalize(staging, keep=["s_suppkey"]), "s_suppkey")


# --- reports -------------------------------------------------------------------------------

# Sums of rounded confidences, so that both engines band the same numbers.
_OVERALL = "round(overall_confidence, 9)"


def _rounded(bugs: DataFrame) -> DataFrame:
    return bugs.withColumn("overall_confidence", F.round("overall_confidence", 9))


_BATCH_SQL = (
    f"SELECT count(*) AS total_processed, round(avg({_OVERALL}), 6) AS mean_confidence, "
    f"count(CASE WHEN {_OVERALL} >= 0.8 THEN 1 END) AS high_confidence, "
    f"count(CASE WHEN {_OVERALL} >= 0.5 AND {_OVERALL} < 0.8 THEN 1 END) AS medium_confidence, "
    f"count(CASE WHEN {_OVERALL} < 0.5 THEN 1 END) AS low_confidence FROM rec"
)


@register("a1_batch_stats", o.with_records(o.LOGS, _BATCH_SQL))
def a1(spark, sf_dir):
    stats = bs.batch_stats(_rounded(records(spark, sf_dir)))
    return stats.withColumn("mean_confidence", r6("mean_confidence"))


_ITEM_REJECTS = f"(SELECT count(*) FROM ({o.ITEMS}) WHERE reject_reason IS NOT NULL)"


_RUN_SQL = (
    f"SELECT ok AS succeeded, {_ITEM_REJECTS} AS failed, ok + {_ITEM_REJECTS} AS total, "
    "round(mean, 6) AS mean_confidence, round(top, 6) AS max_confidence, round(bottom, 6) AS min_confidence, "
    "hi AS high_confidence, mid AS medium_confidence, lo AS low_confidence, "
    "round(100.0 * hi / ok, 6)::DOUBLE AS high_pct, round(100.0 * mid / ok, 6)::DOUBLE AS medium_pct, "
    f"round(100.0 * lo / ok, 6)::DOUBLE AS low_pct FROM (SELECT count(*) AS ok, avg({_OVERALL}) AS mean, "
    f"max({_OVERALL}) AS top, min({_OVERALL}) AS bottom, count(CASE WHEN {_OVERALL} >= 0.8 THEN 1 END) AS hi, "
    f"count(CASE WHEN {_OVERALL} >= 0.5 AND {_OVERALL} < 0.8 THEN 1 END) AS mid, "
    f"count(CASE WHEN {_OVERALL} < 0.5 THEN 1 END) AS lo FROM rec)"
)


@register("a2_run_stats", o.with_records(_ITEMS_K, _RUN_SQL))
def a2(spark, sf_dir):
    staging = bs.read_ado(corpus.work_items(spark, sf_dir))
    _, rejected = bs.split_rejects(staging)
    stats = bs.run_stats(_rounded(bs.normalize(staging)), rejected)
    doubles = [c for c, t in stats.dtypes if t == "double"]
    return stats.withColumns({c: r6(c) for c in doubles})


_RATE_SQL = (
    "SELECT sum(fields_extracted_by_regex)::BIGINT AS fields_extracted, count(*) * 5 AS fields_possible, "
    "round(sum(fields_extracted_by_regex) / (count(*) * 5) * 100, 6)::DOUBLE AS extraction_rate_pct FROM rec"
)


@register("a3_field_extraction_rate", o.with_records(o.LOGS, _RATE_SQL))
def a3(spark, sf_dir):
    rate = bs.field_extraction_rate(records(spark, sf_dir))
    return rate.withColumn("extraction_rate_pct", r6("extraction_rate_pct"))


@register(
    "a4_failed_items",
    "SELECT regexp_extract(path, '[^/]*$') AS item, reason AS error FROM "
    f"(SELECT *, {_FILE_REASON_SQL} AS reason FROM ({_MANIFEST_SQL})) WHERE reason IS NOT NULL",
)
def a4(spark, sf_dir):
    checked = bs.check_manifest(corpus.manifest(spark, sf_dir))
    staging = checked.select(
        F.lit(None).cast("string").alias("text"),
        metadata(
            "error_log", F.col("path"), F.lit(None).cast("string"),
            file_name=tx.file_name(F.col("path")), file_size=F.col("length"),
        ).alias("source_metadata"),
        "reject_reason",
    )
    return bs.failed_items(bs.rejects(staging))


def _quality_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS field, {o.level(f'{f}_confidence')} AS level FROM rec" for f in FIELDS
    )
    return (
        f"SELECT field, level, fields, total, round(100.0 * fields / total, 6)::DOUBLE AS share_pct FROM ("
        f"SELECT f.field, l.level, count(x.level) AS fields, "
        "(SELECT count(*) FROM rec) * CASE WHEN f.field = 'all' THEN 5 ELSE 1 END AS total FROM "
        f"(VALUES {', '.join(f'({o.quote(f)})' for f in (*FIELDS, 'all'))}) f(field) "
        "CROSS JOIN (VALUES ('high'), ('medium'), ('low')) l(level) "
        f"LEFT JOIN ({long}) x ON (x.field = f.field OR f.field = 'all') AND x.level = l.level GROUP BY 1, 2)"
    )


@register("a5_field_quality_distribution", o.with_records(o.LOGS, _quality_sql()))
def a5(spark, sf_dir):
    shares = bs.field_quality_distribution(records(spark, sf_dir))
    return shares.withColumn("share_pct", r6("share_pct"))


def _as_metrics(report: str, sql: str) -> str:
    return (
        f"SELECT '{report}' AS report, metric, value FROM "
        f"(UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM ({sql})) ON COLUMNS(*) INTO NAME metric VALUE value)"
    )


@register(
    "a2_single_pass",
    o.with_records(
        _ITEMS_K,
        " UNION ALL ".join([
            _as_metrics("batch", _BATCH_SQL), _as_metrics("run", _RUN_SQL), _as_metrics("rate", _RATE_SQL),
            f"SELECT 'quality', field || ' ' || level, share_pct FROM ({_quality_sql()})",
            "SELECT 'written', 'records', count(*)::DOUBLE FROM rec",
            f"SELECT 'written', 'sum of confidences', round(sum({_OVERALL}), 3) FROM rec",
        ]),
    ),
)
def a2_single_pass(spark, sf_dir):
    """Records written and reported on in one pass: the reports read what the writing tasks counted."""
    report, out = bs.RunReport(), scratch_dir(spark, "run")
    staging = report.inputs(bs.read_ado(corpus.work_items(spark, sf_dir)))
    bs.write_bugs(report.records(_rounded(bs.normalize(staging))), out, format="parquet")

    def metrics(name: str, frame: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("metric"), r6(F.col(c).cast("double")).alias("value")) for c in frame.columns]
        return frame.select(F.lit(name).alias("report"), F.inline(F.array(*pairs)))

    quality = report.field_quality_distribution().select(
        F.lit("quality").alias("report"), F.concat_ws(" ", "field", "level").alias("metric"), r6("share_pct").alias("value")
    )
    written = spark.read.schema(RECORD).parquet(out).agg(
        F.count(F.lit(1)).alias("records"), F.round(F.sum("overall_confidence"), 3).alias("sum of confidences")
    )
    frames = [
        metrics("batch", report.batch_stats()), metrics("run", report.run_stats()),
        metrics("rate", report.field_extraction_rate()), quality, metrics("written", written),
    ]
    return functools.reduce(DataFrame.unionByName, frames)


_ENRICHED_OVERALL = (
    "(" + " + ".join(
        f"(CASE WHEN {f}_value IS NULL THEN 0.0 ELSE {f}_confidence END)" for f in FIELDS if f != "expected_behavior"
    )
    + f" + CASE WHEN {_NEEDS_EXPECTED} THEN 0.5 WHEN expected_behavior_value IS NULL THEN 0.0 "
    "ELSE expected_behavior_confidence END) / 5.0"
)
_METRIC_BOUNDS = (
    "(VALUES ('mean_overall_confidence', 0.70, 0.50, true), ('mean_fields_by_rules', 4.0, 3.0, true), "
    "('low_confidence_rate', 0.20, 0.40, false), ('enrichment_success_rate', 0.90, 0.70, true)) "
    "b(metric, target, alert_bound, larger)"
)


@register(
    "a6_monitoring_metrics",
    o.with_records(
        o.LOGS,
        "SELECT records, metric, round(value, 6) AS value, target::DOUBLE AS target, alert_bound::DOUBLE AS alert_bound, "
        "CASE WHEN larger THEN value > target ELSE value < target END AS on_target, "
        "CASE WHEN larger THEN value < alert_bound ELSE value > alert_bound END AS alert FROM "
        "(SELECT records, metric, target, alert_bound, larger, CASE metric WHEN 'mean_overall_confidence' THEN mean "
        "WHEN 'mean_fields_by_rules' THEN by_rules WHEN 'low_confidence_rate' THEN low_rate ELSE success END AS value "
        f"FROM {_METRIC_BOUNDS} CROSS JOIN (SELECT count(*) AS records, avg(round(oc, 9)) AS mean, "
        "avg(fields_extracted_by_regex) AS by_rules, avg(CASE WHEN round(oc, 9) < 0.5 THEN 1.0 ELSE 0.0 END) AS low_rate, "
        "avg(CASE WHEN applied THEN changed END) AS success FROM "
        f"(SELECT fields_extracted_by_regex, {_ENRICHED_OVERALL} AS oc, {o.low_fields('0.5')} <> '' AS applied, "
        f"CASE WHEN {_NEEDS_EXPECTED} THEN 1.0 ELSE 0.0 END AS changed FROM rec)))",
    ),
)
def a6(spark, sf_dir):
    bugs = _rounded(records(spark, sf_dir, enable_enrichment=True))
    return bs.monitoring_metrics(bugs).withColumn("value", r6("value"))


@register(
    "a7_extraction_events",
    o.with_records(
        o.LOGS,
        " UNION ALL ".join(
            f"SELECT 'field_extraction' AS event, 'log_' || k AS source_id, '{f}' AS field, "
            f"{f}_confidence AS confidence, {f}_source AS source, {f}_value IS NOT NULL AS success FROM rec"
            for f in FIELDS
        ),
    ),
)
def a7(spark, sf_dir):
    return bs.extraction_events(records(spark, sf_dir)).select(
        "event", "source_id", "field", "confidence", "source", "success"
    )


@register(
    "a8_record_events",
    o.with_records(
        o.LOGS,
        "SELECT 'pipeline_complete' AS event, 'log_' || k AS source_id, 'error_log' AS source_type, "
        f"round({_ENRICHED_OVERALL}, 6) AS overall_confidence, fields_extracted_by_regex AS regex_fields, "
        f"CASE WHEN {_NEEDS_EXPECTED} THEN 1 ELSE 0 END AS nlp_fields FROM rec",
    ),
)
def a8(spark, sf_dir):
    return bs.pipeline_events(records(spark, sf_dir, enable_enrichment=True)).select(
        "event", "source_id", "source_type", r6("overall_confidence").alias("overall_confidence"),
        "regex_fields", "nlp_fields",
    )


# --- batches that come again ----------------------------------------------------------------


@register(
    "n1_incremental_batches",
    o.with_records(
        o.LOGS,
        f"SELECT CASE WHEN k % 2 = 0 THEN 'monday' ELSE 'tuesday' END AS batch, 'log_' || k AS source_id, "
        f"error_type_value AS error_type, round({_OVERALL}, 6) AS overall_confidence FROM rec",
    ),
)
def n1_incremental(spark, sf_dir):
    """Half of the logs, then all of them, then all again: each record once, in the batch it came with."""
    out = scratch_dir(spark, "incremental")
    logs = corpus.logs(spark, sf_dir)
    bs.append_new(logs.where("event_id % 2 = 0"), out, "monday")
    bs.append_new(logs, out, "tuesday")
    bs.append_new(logs, out, "wednesday")
    return _rounded(bs.read_batches(spark, out)).select(
        "batch", "source_metadata.source_id", F.col("error_type.value").alias("error_type"), r6("overall_confidence").alias("overall_confidence")
    )


# --- streams, merging, splitting -----------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table as a stream of its files."""
    schema = corpus.table(spark, sf_dir, table).schema
    return corpus.spread_scan(spark.readStream.schema(schema).parquet(f"{sf_dir}/{table}.parquet*"))


@register("t1_normalize_stream", o.with_records(o.LOGS, _record_select("'log_' || k AS source_id")))
def t1(spark, sf_dir):
    out = scratch_dir(spark, "stream")
    bugs = bs.normalize(corpus.as_logs(_stream(spark, sf_dir, "events")), id_mode="content")
    bs.write_stream(bugs, f"{out}/records", f"{out}/checkpoint").awaitTermination()
    return _flat(
        spark.read.parquet(f"{out}/records"), F.col("source_metadata.source_id").alias("source_id")
    )


def _streamed_files(spark: SparkSession, files: str) -> DataFrame:
    out = scratch_dir(spark, "stream")
    queries = bs.normalize_stream(
        spark, f"{files}/*", f"{out}/records", f"{out}/checkpoint", max_mb=MAX_FILE_MB, rejects_out=f"{out}/rejects"
    )
    for q in queries:
        q.awaitTermination()
    chunk = F.regexp_extract("source_id", r"chunk=(-?\d+)/", 1).cast("bigint")
    chunk = F.when(chunk >= 0, chunk).alias("chunk")  # empty files have numbers below zero
    good = spark.read.schema(RECORD).parquet(f"{out}/records").select("source_metadata.*").select(
        chunk, "raw_text_length", F.lit(None).cast("string").alias("reject_reason")
    )
    bad = spark.read.schema("source_id string, reject_reason string").parquet(f"{out}/rejects").select(
        chunk, F.lit(None).cast("int").alias("raw_text_length"), "reject_reason"
    )
    return good.unionByName(bad)


@register("t1_stream_all_lines", f"SELECT chunk, raw_text_length, reject_reason FROM ({_ALL_FILES_SQL})")
@register("t1_stream_files", f"SELECT chunk, raw_text_length, reject_reason FROM ({_ALL_FILES_SQL})")
def t1_files(spark, sf_dir):
    """Files as a stream: records of those accepted, empty ones too, rejects of the others."""
    return _streamed_files(spark, _write_all_lines(spark, sf_dir))


@register(
    "t2_windowed_monitoring",
    o.with_records(
        o.LOGS,
        "SELECT CAST(window_start AS VARCHAR) AS window_start, count(*) AS records, "
        "round(avg(round(oc, 9)), 9) AS mean_overall_confidence, "
        "round(avg(fields_extracted_by_regex), 9) AS mean_fields_by_rules, "
        "round(avg(CASE WHEN round(oc, 9) < 0.5 THEN 1.0 ELSE 0.0 END), 9) AS low_confidence_rate, "
        "round(avg(CASE WHEN applied THEN changed END), 9) AS enrichment_success_rate FROM "
        f"(SELECT date_trunc('hour', ts) AS window_start, fields_extracted_by_regex, {_ENRICHED_OVERALL} AS oc, "
        f"{o.low_fields('0.5')} <> '' AS applied, CASE WHEN {_NEEDS_EXPECTED} THEN 1.0 ELSE 0.0 END AS changed "
        "FROM rec JOIN (SELECT event_id, ts FROM events) e ON e.event_id = rec.k) GROUP BY 1",
    ),
)
def t2(spark, sf_dir):
    """A window comes out when a later event moves the watermark past its end; one that is a
    day later than all others closes the last windows, and its own stays open."""
    out = scratch_dir(spark, "windows")
    events = corpus.table(spark, sf_dir, "events")
    last = events.agg(F.max("ts").alias("ts")).select(
        *[(F.col("ts") + F.expr("INTERVAL 1 DAY") if c == "ts" else F.lit(None)).cast(t).alias(c) for c, t in events.dtypes]
    )
    events.unionByName(last).write.parquet(f"{out}/events")
    stream = corpus.spread_scan(spark.readStream.schema(events.schema).parquet(f"{out}/events"))
    bugs = bs.normalize(
        corpus.as_logs(stream.withColumn("ts", F.col("ts").cast("timestamp"))),
        id_mode="content", keep=["ts"], enable_enrichment=True,
    )
    windows = bs.windowed_monitoring(_rounded(bugs), "ts", "1 hour", "10 minutes")
    bs.write_stream(windows, f"{out}/metrics", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/metrics").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "records",
        *[
            F.round(c, 9).alias(c)
            for c in ("mean_overall_confidence", "mean_fields_by_rules", "low_confidence_rate", "enrichment_success_rate")
        ],
    )


_LATE = (
    "event_id % 10 >= 7 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= "
    "(SELECT max(ts) FROM events WHERE event_id % 10 < 7) - INTERVAL 10 MINUTE"
)


@register(
    "t2_late_rows",
    o.with_records(
        o.LOGS,
        "SELECT CAST(window_start AS VARCHAR) AS window_start, late, count(*) AS records, "
        "round(avg(round(oc, 9)), 6) AS mean_overall_confidence FROM "
        f"(SELECT date_trunc('hour', ts) AS window_start, {_LATE} AS late, {_OVERALL} AS oc "
        "FROM rec JOIN (SELECT event_id, ts FROM events) e ON e.event_id = rec.k) GROUP BY 1, 2",
    ),
)
def t2_late(spark, sf_dir):
    """Three tenths of the events come after the others: those whose window is over by then are kept apart."""
    out = scratch_dir(spark, "late")
    events = corpus.table(spark, sf_dir, "events")
    for some in ("event_id % 10 < 7", "event_id % 10 >= 7"):
        events.where(some).write.mode("append").parquet(f"{out}/events")
        stream = corpus.spread_scan(spark.readStream.schema(events.schema).parquet(f"{out}/events"))
        bugs = bs.normalize(corpus.as_logs(stream.withColumn("ts", F.col("ts").cast("timestamp"))), id_mode="content", keep=["ts"])
        bs.monitor_with_late_rows(_rounded(bugs), out, f"{out}/checkpoint", "ts").awaitTermination()
    kept = bs.window_metrics(spark, out).select("window_start", F.lit(False).alias("late"), "records", "mean_overall_confidence")
    late = bs.late_records(spark, out).groupBy(F.date_trunc("hour", "ts").alias("window_start")).agg(
        F.lit(True).alias("late"), F.count(F.lit(1)).alias("records"), F.avg("overall_confidence").alias("mean_overall_confidence")
    )
    return kept.unionByName(late).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "late", "records",
        r6("mean_overall_confidence").alias("mean_overall_confidence"),
    )


@register(
    "t2_windowed_quantiles",
    o.with_records(
        o.LOGS,
        "SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, count(*) AS records, "
        + ", ".join(f"round(quantile_disc({_OVERALL}, {p}), 6) AS p{100 * p:g}" for p in (0.05, 0.5, 0.95))
        + " FROM rec JOIN (SELECT event_id, ts FROM events) e ON e.event_id = rec.k GROUP BY 1",
    ),
)
def t2_quantiles(spark, sf_dir):
    events = corpus.as_logs(corpus.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    windows = bs.windowed_quantiles(_rounded(bs.normalize(events, keep=["ts"])), "ts")
    return windows.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "records",
        *[r6(c).alias(c) for c in ("p5", "p50", "p95")],
    )


def _merged_sql() -> str:
    """The best filled field per user; ties by source weight, then by the larger value."""
    picks = ", ".join(
        f"(SELECT {{'v': {f}_value, 'c': {f}_confidence}}) AS {f}" for f in FIELDS
    )
    best = []
    for f in FIELDS:
        best.append(
            f"arg_max({{'v': {f}_value, 'c': {f}_confidence, 's': {f}_source}}, "
            f"{{'a': CASE WHEN {f}_value IS NULL THEN 0 ELSE 1 END, 'b': {f}_confidence, "
            f"'c': CASE {f}_source WHEN 'regex_strict' THEN 0.95 ELSE 0.7 END, "
            f"'d': coalesce({f}_value, '')}}) AS {f}"
        )
    out = ", ".join(
        f"{f}.v AS {f}_value, round({f}.c, 6) AS {f}_confidence, {f}.s AS {f}_source" for f in FIELDS
    )
    total = " + ".join(f"(CASE WHEN {f}.v IS NULL THEN 0.0 ELSE {f}.c END)" for f in FIELDS)
    return (
        f"SELECT user_id, records, {out}, round(({total}) / 5.0, 6) AS overall_confidence FROM "
        f"(SELECT user_id, count(*) AS records, {', '.join(best)} FROM rec "
        "JOIN (SELECT event_id, CASE WHEN user_id % 7 <> 0 THEN user_id END AS user_id FROM events) e "
        "ON e.event_id = rec.k GROUP BY user_id, CASE WHEN user_id IS NULL THEN event_id END)"
    )


@register("t3_merge_evidence", o.with_records(o.LOGS, _merged_sql()))
def t3(spark, sf_dir):
    # Some records have no key; they belong together no more than strangers do.
    key = F.when(F.col("user_id") % 7 != 0, F.col("user_id"))
    bugs = bs.normalize(corpus.logs(spark, sf_dir).withColumn("user_id", key), keep=["user_id"])
    return _merged_rows(bs.merge_evidence(bugs, "user_id"))


def _merged_rows(merged: DataFrame) -> DataFrame:
    cols = []
    for f in FIELDS:
        cols += [
            F.col(f"{f}.value").alias(f"{f}_value"), r6(f"{f}.confidence").alias(f"{f}_confidence"),
            F.col(f"{f}.source").alias(f"{f}_source"),
        ]
    return merged.select("user_id", "records", *cols, r6("overall_confidence").alias("overall_confidence"))


@register("t3_merge_stream", o.with_records(o.LOGS, _merged_sql()))
def t3_stream(spark, sf_dir):
    """The events in two arrivals: the merged rows are those of all events at once."""
    out = scratch_dir(spark, "merge")
    events = corpus.table(spark, sf_dir, "events")
    for some in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        events.where(some).write.mode("append").parquet(f"{out}/events")
        stream = corpus.spread_scan(spark.readStream.schema(events.schema).parquet(f"{out}/events"))
        logs = corpus.as_logs(stream.withColumn("user_id", F.when(F.col("user_id") % 7 != 0, F.col("user_id"))))
        bugs = bs.normalize(logs, id_mode="content", keep=["user_id"])
        bs.merge_stream(bugs, "user_id", out, f"{out}/checkpoint").awaitTermination()
    return _merged_rows(bs.merged_incidents(spark, out, "user_id"))


# The paragraphs of a document as separate reports.
_SEVERAL = "replace(text, '. ', '.' || chr(10) || repeat('=', 12) || chr(10))"


@register(
    "t4_split_reports",
    "SELECT doc_id, part, length(t) AS n, md5(t) AS text_md5 FROM (SELECT doc_id, t, part FROM ("
    "SELECT doc_id, unnest(parts) AS t, unnest(range(1, len(parts) + 1)) AS part FROM ("
    "SELECT doc_id, regexp_split_to_array(d, '(?m:^={10,}[ \\t]*$)\\n?') AS parts FROM "
    f"(SELECT doc_id, {_SEVERAL} AS d FROM documents))) WHERE trim(regexp_replace(t, '\\s+', ' ', 'g'), ' ') <> '')",
)
def t4(spark, sf_dir):
    documents = corpus.table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_SEVERAL} AS text")
    staging = documents.select(
        "text",
        metadata("freetext", F.col("doc_id").cast("string"), F.col("text")).alias("source_metadata"),
        "doc_id",
    )
    parts = bs.split_reports(staging)
    return parts.select(
        "doc_id",
        F.substring_index("source_metadata.source_id", "#", -1).cast("bigint").alias("part"),
        F.length("text").alias("n"), md5("text").alias("text_md5"),
    )


@functools.cache
def flagship() -> Query:
    """What broke, where and how sure: records of all three sources, banded per source type."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bugs = bs.normalize(mixed(spark, sf_dir))
        return (
            bugs.groupBy(
                F.col("source_metadata.source_type").alias("source_type"),
                F.col("error_type.value").alias("error_type"),
                F.col("component_module.value").alias("component_module"),
            )
            .agg(
                F.count(F.lit(1)).alias("reports"),
                # A mean may end in a half at the last digit kept; the engines round halves apart.
                F.round(F.avg("overall_confidence") + 1e-9, 6).alias("mean_confidence"),
            )
        )

    return run


_ALL_TEXTS = (
    "SELECT row_number() OVER () AS k, source_type, text FROM ("
    f"SELECT 'error_log' AS source_type, text FROM ({o.LOGS}) UNION ALL "
    f"SELECT 'freetext', text FROM ({o.FREE_CLEAN}) WHERE reject_reason IS NULL UNION ALL "
    f"SELECT 'ado_bug', text FROM ({o.ITEMS}) WHERE reject_reason IS NULL)"
)

register(
    "flagship_what_broke",
    o.with_records(
        _ALL_TEXTS,
        "SELECT source_type, error_type_value AS error_type, component_module_value AS component_module, "
        "count(*) AS reports, round(avg(overall_confidence) + 1e-9, 6) AS mean_confidence FROM rec JOIN "
        "(SELECT k, source_type FROM src) s USING (k) GROUP BY 1, 2, 3",
    ),
)(flagship())
