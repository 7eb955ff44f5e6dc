"""Files: whole log files as texts, document placeholders, file checks on a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bugsieve.functions import text as tx
from bugsieve.sources.inventory import inventory, sizes_of
from bugsieve.sources.staging import metadata

MAX_FILE_MB = 50
_MB = 1024 * 1024
LOG_GLOB = "*.{[lL][oO][gG],[tT][xX][tT]}"
SCAN_GLOB = "*.{log,txt}"
DOCUMENT_GLOB = "*.{[pP][dD][fF],[dD][oO][cC],[dD][oO][cC][xX]}"

_LISTING = "path string, modificationTime timestamp, length long, content binary"


def _without_scheme(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def _plain_path() -> Column:
    """The file's path. ``_metadata.file_path`` is a URI, the listing's ``path`` is not: only
    the first has percent escapes to decode, so every reader takes this one."""
    uri = F.col("_metadata.file_path")
    return _without_scheme(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))))


def _listing(reader, path: str | list[str]) -> DataFrame:
    """Paths and sizes of files; contents are not read."""
    frame = reader.format("binaryFile").schema(_LISTING).load(path)
    other = [c for c in frame.columns if c not in ("path", "modificationTime", "length", "content")]
    return frame.select(_plain_path().alias("path"), F.col("_metadata.file_size").alias("size"), *other)


def log_text(raw: Column) -> Column:
    """Text of a file: bytes that are not UTF-8 dropped, line ends turned into newlines."""
    return tx.normalize_newlines(tx.drop_invalid_utf8(raw))


def read_error_logs(
    spark: SparkSession,
    path: str | list[str],
    max_mb: float = MAX_FILE_MB,
    pattern: str = LOG_GLOB,
    recursive: bool = False,
) -> DataFrame:
    """One staging row per log file of a folder; the whole file is one text.

    Files over the size limit keep their row, with a reject reason, and are not opened: the
    two branches differ by a filter on the file size, which prunes files before the read.
    Files of zero bytes, which Spark's file sources pass over, give a row with an empty text; they
    come from an ``inventory`` that tasks make, folder by folder.
    Subfolders named ``key=value`` become columns, null for empty files.
    """

    def options(reader):
        reader = reader.option("pathGlobFilter", pattern)
        return reader.option("recursiveFileLookup", True) if recursive else reader

    limit = int(max_mb * _MB)
    size = F.col("_metadata.file_size")
    files = options(spark.read).text(path, wholetext=True)
    other = [c for c in files.columns if c != "value"]
    good = files.where(size <= limit).select(
        log_text(F.col("value")).alias("text"), _plain_path().alias("path"), size.alias("size"),
        F.lit(None).cast("string").alias("reject_reason"), *other,
    )
    listed = options(spark.read).format("binaryFile").load(path)
    oversize = oversize_files(listed.select("*", _plain_path().alias("plain")), "plain", "length", max_mb, other)
    none = [F.lit(None).cast(files.schema[c].dataType).alias(c) for c in other]
    empty = inventory(spark, path, pattern, recursive).where("size = 0").select(
        F.lit("").alias("text"), "path", "size", F.lit(None).cast("string").alias("reject_reason"), *none
    )
    return _file_staging(good.unionByName(oversize).unionByName(empty))


def oversize_files(listed: DataFrame, path: str, size: str, max_mb: float, other: list[str]) -> DataFrame:
    """Reject rows, without a text, for the files of a listing that are over the limit."""
    return listed.where(F.col(size) > int(max_mb * _MB)).select(
        F.lit(None).cast("string").alias("text"), F.col(path).alias("path"), F.col(size).alias("size"),
        too_large(F.col(size), max_mb).alias("reject_reason"), *other,
    )


def _file_staging(files: DataFrame) -> DataFrame:
    kept = [c for c in files.columns if c not in ("text", "path", "size", "reject_reason")]
    return files.select(
        "text",
        metadata(
            "error_log",
            F.col("path"),
            F.col("text"),
            file_name=tx.file_name(F.col("path")),
            file_size=F.col("size"),
        ).alias("source_metadata"),
        "reject_reason",
        *kept,
    )


def scan_directory(spark: SparkSession, path: str, max_mb: float = MAX_FILE_MB) -> DataFrame:
    """All ``.log`` and ``.txt`` files directly in a folder, in one read."""
    return read_error_logs(spark, path, max_mb=max_mb, pattern=SCAN_GLOB)


def too_large(size: Column, max_mb: float) -> Column:
    return F.format_string(
        f"File size (%.2f MB) exceeds maximum allowed ({max_mb} MB)", size / _MB
    )


def file_reject_reason(path: Column, size: Column, max_mb: int = MAX_FILE_MB) -> Column:
    """Why a listed file cannot be read; NULL when it can. A NULL size means it is missing."""
    suffix = tx.file_suffix(path)
    return (
        F.when(size.isNull(), F.concat(F.lit("File not found: "), path))
        .when(
            ~suffix.isin(*tx.SUPPORTED_SUFFIXES),
            F.concat(F.lit("Unsupported file type: "), _written_suffix(path)),
        )
        .when(size > max_mb * _MB, too_large(size, max_mb))
    )


def _written_suffix(path: Column) -> Column:
    return F.regexp_extract(tx.file_name(path), r"^.+(\.[^.]+)$", 1)


def check_manifest(
    manifest: DataFrame, path: str = "path", size: str = "length", max_mb: int = MAX_FILE_MB
) -> DataFrame:
    """Add ``reject_reason`` to a table of file paths and sizes."""
    return manifest.withColumn("reject_reason", file_reject_reason(F.col(path), F.col(size), max_mb))


def check_paths(requested: DataFrame, path: str = "path", max_mb: int = MAX_FILE_MB) -> DataFrame:
    """The requested file paths with ``length``, ``modified`` and ``reject_reason``: missing files,
    other types, too large ones. Tasks list the folders of the paths; no file is opened."""
    return check_manifest(sizes_of(requested, path), path, "length", max_mb)


def empty_files(manifest: DataFrame, path: str = "path", size: str = "length") -> DataFrame:
    """Staging rows with an empty text for the zero-byte log files of a manifest."""
    p = F.col(path)
    kept = [c for c in manifest.columns if c not in (path, size)]
    return _file_staging(
        manifest.where((F.col(size) == 0) & tx.file_suffix(p).isin(".log", ".txt")).select(
            F.lit("").alias("text"),
            p.alias("path"),
            F.col(size).alias("size"),
            F.lit(None).cast("string").alias("reject_reason"),
            *kept,
        )
    )


def missing_files(requested: DataFrame, staging: DataFrame, path: str = "path") -> DataFrame:
    """Rejects for the requested paths that a file scan did not find."""
    found = staging.select(F.col("source_metadata.source_id").alias(path))
    return requested.join(found, path, "left_anti").select(
        F.lit("error_log").alias("source_type"),
        F.col(path).alias("source_id"),
        tx.file_name(F.col(path)).alias("file_name"),
        F.concat(F.lit("File not found: "), F.col(path)).alias("reject_reason"),
    )


def document_placeholders(
    manifest: DataFrame, path: str = "path", size: str = "length", max_mb: int = MAX_FILE_MB
) -> DataFrame:
    """Staging rows for the document files of a manifest: a placeholder text with the name."""
    p = F.col(path)
    suffix = tx.file_suffix(p)
    name = tx.file_name(p)
    text = F.when(
        suffix == ".pdf", F.concat(F.lit("[PDF content from "), name, F.lit("]"))
    ).otherwise(F.concat(F.lit("[DOC content from "), name, F.lit("]")))
    kept = [c for c in manifest.columns if c not in (path, size)]
    return _file_staging(
        manifest.where(suffix.isin(".pdf", ".doc", ".docx")).select(
            text.alias("text"),
            p.alias("path"),
            F.col(size).alias("size"),
            file_reject_reason(p, F.col(size), max_mb).alias("reject_reason"),
            *kept,
        )
    )


def read_binary_docs(
    spark: SparkSession, path: str | list[str], max_mb: int = MAX_FILE_MB, recursive: bool = False
) -> DataFrame:
    """Staging rows for the PDF and Word files of a folder. Their content is not read."""
    reader = spark.read.option("pathGlobFilter", DOCUMENT_GLOB)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return document_placeholders(_listing(reader, path), size="size", max_mb=max_mb)


def read_folder(
    spark: SparkSession, path: str | list[str], max_mb: float = MAX_FILE_MB, recursive: bool = False
) -> DataFrame:
    """Staging rows for every file of a folder: logs, documents, and rejects for all others."""
    reader = spark.read.option("recursiveFileLookup", True) if recursive else spark.read
    listed = _listing(reader, path)
    other = listed.where(~tx.file_suffix(F.col("path")).isin(*tx.SUPPORTED_SUFFIXES))
    rejected = _file_staging(
        other.select(
            F.lit(None).cast("string").alias("text"), "path", "size",
            file_reject_reason(F.col("path"), F.col("size"), max_mb).alias("reject_reason"),
        )
    )
    logs = read_error_logs(spark, path, max_mb, recursive=recursive)
    documents = read_binary_docs(spark, path, max_mb, recursive)
    kept = ["text", "source_metadata", "reject_reason"]
    return logs.select(*kept).unionByName(documents.select(*kept)).unionByName(rejected.select(*kept))
