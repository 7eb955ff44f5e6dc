"""What folders hold: names, sizes and times, listed by tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bugsieve.sources.scratch import scratch_dir

#: Rows of one batch of a listing.
_ROWS = 10_000
#: Storage schemes that go by another name here.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}
_LISTED = "path string, size long, modified double, folder boolean, rest array<string>"


def glob_regex(pattern: str) -> str:
    """A file name glob (``* ? [a-z] [!a] {x,y}``) as a regular expression for whole names."""
    out, depth, at = [], 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[" and "]" in pattern[at + 2 :]:
            end = pattern.index("]", at + 2)
            inside = pattern[at + 1 : end].replace("\\", r"\\")
            out.append("[^" + inside[1:] + "]" if inside[0] in "!^" else "[" + inside + "]")
            at = end
        elif c == "{" and "}" in pattern[at:]:
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        else:
            if c == "\\" and at + 1 < len(pattern):
                at += 1
            out.append(re.escape(pattern[at]))
        at += 1
    return "".join(out)


def is_data(name: str) -> bool:
    """Whether Spark's file sources would look at a file or folder of that name."""
    return not (name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"))


def storage(path: str) -> tuple[pafs.FileSystem, str, str]:
    """The file system of a path, the path there, and what its paths begin with outside of it."""
    scheme = path.split("://", 1)[0] if "://" in path else "file" if path.startswith("file:") else ""
    if scheme in ("", "file"):
        return pafs.LocalFileSystem(), re.sub("^file:/+", "/", path), ""
    system, inner = pafs.FileSystem.from_uri(_SCHEMES.get(scheme, scheme) + path[len(scheme):])
    return system, inner, path.removesuffix(inner)


def list_folder(path: str) -> Iterator[tuple[str, int, float, bool]]:
    """(path, size, modification time, is a folder) of what lies directly in a folder, or of a file.

    Nothing for a path that is not there. Local folders of any size are read entry by entry.
    """
    system, inner, prefix = storage(path)
    if isinstance(system, pafs.LocalFileSystem):
        try:
            with os.scandir(inner) as entries:
                for e in entries:
                    try:
                        s = e.stat()
                        yield f"{inner.rstrip('/')}/{e.name}", 0 if e.is_dir() else s.st_size, s.st_mtime, e.is_dir()
                    except FileNotFoundError:  # gone since
                        continue
        except FileNotFoundError:
            return
        except NotADirectoryError:
            s = os.stat(inner)
            yield inner, s.st_size, s.st_mtime, False
        return
    info = system.get_file_info(inner)
    found = [info] if info.type == pafs.FileType.File else system.get_file_info(
        pafs.FileSelector(inner, allow_not_found=True))
    for i in found:
        modified = (i.mtime_ns or 0) / 1e9
        yield prefix + i.path, i.size or 0, modified, i.type == pafs.FileType.Directory


def _list_in_tasks(folders: DataFrame, recursive: bool) -> DataFrame:
    """The entries of each folder; those that are folders carry what is left of their pattern."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.float64(), pa.bool_(), pa.list_(pa.string()))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            made = [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(made, names=["path", "size", "modified", "folder", "rest"])

        for batch in batches:
            for folder, rest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                wanted = re.compile(rest[0]) if rest else None
                for path, size, modified, is_folder in list_folder(folder):
                    name = path.rsplit("/", 1)[-1]
                    if not is_data(name) or (wanted and not wanted.fullmatch(name)):
                        continue
                    left = rest[1:]
                    if is_folder and not (rest or recursive or "=" in name):
                        continue
                    if not is_folder and left:
                        continue
                    rows.append((path, size, modified, is_folder, left))
                    if len(rows) >= _ROWS:
                        yield out()
        yield out()

    return folders.mapInArrow(run, _LISTED)


def _rooted(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """The part of a path before its first pattern, with its storage, and the patterns after it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    parts = whole.rstrip("/").split("/")
    first = next((i for i, p in enumerate(parts) if re.search(r"[*?\[{]", p)), len(parts))
    return "/".join(parts[:first]) or "/", [glob_regex(p) for p in parts[first:]]


def inventory(
    spark: SparkSession, path: str | list[str], pattern: str = "*", recursive: bool = False
) -> DataFrame:
    """(path, size, modified): every file that Spark's file sources would find, and zero-byte ones.

    Folders are rows: each task lists its own, and the folders found make the next round, so no list of
    names passes the driver. As in Spark's sources, ``path`` may hold globs, ``pattern`` filters names,
    folders named ``key=value`` are entered (others if ``recursive``) and names that begin with ``_`` or
    ``.`` are passed over. Each round is a table below the shared folder. A path that is not there gives
    no rows. Paths are plain (``/a/b``) on a local or mounted file system, URIs elsewhere; ``modified``
    is in seconds since 1970.
    """
    roots = [_rooted(spark, p) for p in ([path] if isinstance(path, str) else path)]
    todo = spark.createDataFrame(roots, "folder string, rest array<string>")
    files = None
    while True:
        at = scratch_dir(spark, "inventory")
        _list_in_tasks(todo.repartition("folder"), recursive).write.parquet(at)
        listed = spark.read.schema(_LISTED).parquet(at)
        here = listed.where(~F.col("folder")).select("path", "size", F.timestamp_seconds("modified").alias("modified"))
        files = here if files is None else files.unionByName(here)
        todo = listed.where("folder").select(F.col("path").alias("folder"), "rest")
        if todo.isEmpty():
            break
    name = F.substring_index("path", "/", -1)
    return files.where(name.rlike(f"^(?:{glob_regex(pattern)})$")) if pattern != "*" else files


def sizes_of(requested: DataFrame, path: str = "path") -> DataFrame:
    """The requested paths with the size and modification time of their file (``length``,
    ``modified``), null where there is none: their folders are listed by tasks and joined. Columns of
    these names in ``requested`` give way."""
    asked = requested.drop("length", "modified")
    plain = F.regexp_replace(F.col(path), "^file:/+", "/")
    folders = asked.select(F.regexp_replace(plain, "/[^/]*$", "").alias("folder"), F.array().cast("array<string>").alias("rest"))
    listed = _list_in_tasks(folders.where("folder <> ''").distinct().repartition("folder"), False).where(~F.col("folder"))
    found = listed.select(
        F.col("path").alias("path_listed"), F.col("size").alias("length"),
        F.timestamp_seconds("modified").alias("modified"),
    )
    return asked.join(found, plain == F.col("path_listed"), "left").drop("path_listed")
