"""A streaming source of whole files that accounts for every file of a folder, empty ones too."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from bugsieve.sources.inventory import glob_regex, is_data, list_folder, storage

#: Bytes of files, and files, that one task reads.
TASK_BYTES, TASK_FILES = 64 * 1024 * 1024, 2_000
#: Bytes of contents handed on at once (but for one larger file).
BATCH_BYTES = 16 * 1024 * 1024

SCHEMA = "path string, size long, modified timestamp, content binary"


@dataclass
class Files(InputPartition):
    """The files that one task reads: (path, size, seconds since 1970)."""

    entries: list[tuple[str, int, float]]


class Ledger:
    """The files a stream has taken in, by batch: number n is the file ``n.json`` of a folder.

    A batch is written, under its final name at once, before Spark hears of its number. A stream that is
    started again finds the same batches, so each file counts once; nothing else holds the state.
    """

    def __init__(self, folder: str) -> None:
        self.system, self.folder, _ = storage(folder)
        self.system.create_dir(self.folder, recursive=True)
        self.last = 0
        self.seen: set[tuple[str, int, float]] = set()

    def _name(self, n: int) -> str:
        return f"{self.folder.rstrip('/')}/{n}.json"

    def batch(self, n: int) -> list[tuple[str, int, float]]:
        with self.system.open_input_stream(self._name(n)) as file:
            return [tuple(json.loads(line)) for line in file.read().splitlines()]

    def catch_up(self) -> None:
        """Read the batches that are there and not yet known."""
        while self.system.get_file_info(self._name(self.last + 1)).type == pafs.FileType.File:
            self.seen.update(self.batch(self.last + 1))
            self.last += 1

    def add(self, entries: list[tuple[str, int, float]]) -> None:
        n = self.last + 1
        data = b"".join(json.dumps(e).encode() + b"\n" for e in entries)
        with self.system.open_output_stream(f"{self._name(n)}.new") as file:
            file.write(data)
        self.system.move(f"{self._name(n)}.new", self._name(n))
        self.seen.update(entries)
        self.last = n


def find_files(path: str, pattern: str, recursive: bool) -> Iterator[tuple[str, int, float]]:
    """(path, size, modification time) of the files of a folder, a glob of folders or a tree."""
    name = re.compile(glob_regex(pattern))
    parts = path.rstrip("/").split("/")
    first = next((i for i, p in enumerate(parts) if re.search(r"[*?\[{]", p)), len(parts))
    todo = [("/".join(parts[:first]) or "/", [re.compile(glob_regex(p)) for p in parts[first:]])]
    while todo:
        folder, rest = todo.pop()
        for found, size, modified, is_folder in list_folder(folder):
            own = found.rsplit("/", 1)[-1]
            if not is_data(own) or (rest and not rest[0].fullmatch(own)):
                continue
            if is_folder and (rest or recursive or "=" in own):
                todo.append((found, rest[1:]))
            elif not is_folder and not rest[1:] and name.fullmatch(own):
                yield found, size, modified


class FolderReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.path, self.ledger_folder = options["path"], options["ledger"]
        self.pattern = options.get("pattern", "*")
        self.recursive = options.get("recursive", "false").lower() == "true"
        self.limit = int(options.get("maxbytes", 1 << 62))
        self.per_trigger = int(options.get("maxfilespertrigger", 1 << 62))
        self._ledger: Ledger | None = None

    @property
    def ledger(self) -> Ledger:
        if self._ledger is None:
            self._ledger = Ledger(self.ledger_folder)
        self._ledger.catch_up()
        return self._ledger

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self) -> dict:
        """The number of the last batch; files that no batch has make a new one, oldest first."""
        ledger = self.ledger
        new = [f for f in find_files(self.path, self.pattern, self.recursive) if f not in ledger.seen]
        new.sort(key=lambda f: (f[2], f[0]))
        if new:
            ledger.add(new[: self.per_trigger])
        return {"batch": ledger.last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out: list[InputPartition] = []
        size = 0
        for n in range(start["batch"] + 1, end["batch"] + 1):
            for entry in self.ledger.batch(n):
                cost = entry[1] if entry[1] <= self.limit else 0
                # The first file opens a task of its own accord: it may cost nothing (empty or too large).
                if not out or size + cost > TASK_BYTES or len(out[-1].entries) >= TASK_FILES:
                    out.append(Files([]))
                    size = 0
                out[-1].entries.append(entry)
                size += cost
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.binary())
            made = [pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(made, names=["path", "size", "modified", "content"])

        for path, size, modified in partition.entries:
            content = None
            if size <= self.limit:
                system, inner, _ = storage(path)
                try:
                    with system.open_input_stream(inner) as file:
                        content = file.read()
                except FileNotFoundError:
                    size = None  # gone since it was listed
            rows.append((path, size, dt.datetime.fromtimestamp(modified, dt.UTC), content))
            held += len(content or b"")
            if held >= BATCH_BYTES:
                yield out()
                held = 0
        if rows:
            yield out()


class LogFolder(DataSource):
    """``spark.readStream.format("log_folder")``: (path, size, modified, content) of whole files.

    Options: ``path`` (a folder, a glob of folders), ``ledger`` (a folder of this stream's own, on
    storage that driver and executors share), ``pattern`` (of names), ``recursive``, ``maxBytes``
    (larger files have a null content and are not opened) and ``maxFilesPerTrigger``. A file is known by
    (path, size, modification time): one that changes counts again. A file that vanishes before it
    is read has a null size.
    """

    @classmethod
    def name(cls) -> str:
        return "log_folder"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: object) -> DataSourceStreamReader:
        return FolderReader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LogFolder)
