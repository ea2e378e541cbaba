"""A stream of row events from a folder of numbered change files, as a Python data source.

Each file (for example bin.000001) holds one JSON object a line: database, table, op_type, keys, rows, ts. A position
is a file and a byte in it. Lines that are still being written, without their end, wait for the next batch. Every
file with new lines is one partition, so executors read them side by side; all of them must see the folder.
Register with spark.dataSource.register(BinlogSource).
"""

from __future__ import annotations

import io
import json
import re
from collections.abc import Iterator
from datetime import datetime

from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "binlog_file string, binlog_pos bigint, database string, table string, op_type string, keys array<string>, rows array<map<string,string>>, source_timestamp timestamp"
TAIL = 1 << 20


class Span(InputPartition):
    def __init__(self, name: str, start: int, stop: int):
        self.name, self.start, self.stop = name, start, stop


class BinlogSource(DataSource):
    """Options: path (a folder), include (a pattern for database.table), file and pos (where to begin), startingPosition (latest, as a
    replica would, or earliest) where these are not given."""

    @classmethod
    def name(cls) -> str:
        return "binlog"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return BinlogReader(dict(self.options))


class BinlogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.options = options["path"].rstrip("/"), options
        self.include = re.compile(options.get("include", ".*"))

    def _open(self):
        return pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)

    def _files(self) -> list[tuple[str, int]]:
        store, base = self._open()
        found = store.get_file_info(pafs.FileSelector(base, allow_not_found=True))
        return sorted((f.base_name, f.size) for f in found if f.is_file and not f.base_name.startswith("."))

    def _end(self, name: str, size: int) -> int:
        """The byte after the last whole line."""
        store, base = self._open()
        with store.open_input_file(f"{base}/{name}") as file:
            stop = size
            while stop > 0:
                start = max(0, stop - TAIL)
                at = file.read_at(stop - start, start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                stop = start
        return 0

    def latestOffset(self) -> dict:
        files = self._files()
        return {"file": files[-1][0], "pos": self._end(*files[-1])} if files else {"file": "", "pos": 0}

    def initialOffset(self) -> dict:
        if self.options.get("file"):
            return {"file": self.options["file"], "pos": int(self.options.get("pos", 0))}
        return {"file": "", "pos": 0} if self.options.get("startingposition", self.options.get("startingPosition", "latest")) == "earliest" else self.latestOffset()

    def partitions(self, start: dict, end: dict) -> list[Span]:
        out = []
        for name, size in self._files():
            if start["file"] <= name <= end["file"]:
                low = start["pos"] if name == start["file"] else 0
                high = end["pos"] if name == end["file"] else self._end(name, size)
                if low < high:
                    out.append(Span(name, low, high))
        return out

    def read(self, partition: Span) -> Iterator[tuple]:
        store, base = self._open()
        with io.BufferedReader(store.open_input_file(f"{base}/{partition.name}"), TAIL) as file:
            file.seek(partition.start)
            at = partition.start
            while at < partition.stop:
                line = file.readline()
                place, at = at, at + len(line)
                try:
                    e = json.loads(line)
                    wanted = self.include.fullmatch(f"{e['database']}.{e['table']}")
                    row = (partition.name, place, e["database"], e["table"], e["op_type"], e["keys"], [{k: None if v is None else v if isinstance(v, str) else json.dumps(v) for k, v in r.items()} for r in e["rows"]], datetime.fromisoformat(e["ts"]) if e.get("ts") else None)
                except (ValueError, KeyError, TypeError, AttributeError):
                    continue  # a line that is no row event
                if wanted:
                    yield row
