"""A streaming sink whose readers see whole transactions: `writeStream.format("two_phase")`.

Tasks write staged files and send their names. When all tasks of a micro-batch are done, the driver names these files in
one commit file for the producer and the batch; when one fails, what the others staged is deleted. A batch that runs again after a crash finds its
commit and deletes what it has staged, so it is written once. Readers (`committed`) look at commits only.

Options: path, a folder that driver and executors share; producer, the name under which batches are numbered. Rows are written as they come, batch
by batch, so a task holds one Arrow batch. Empty tasks stage nothing; a micro-batch without rows is a commit without files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from clinlake.sources.store import Folder


@dataclass
class Staged(WriterCommitMessage):
    file: str | None
    rows: int


def _folder(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class TwoPhaseWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, producer: str):
        self.path, self.producer = path.rstrip("/"), producer

    def write(self, iterator: Iterator) -> Staged:
        import pyarrow.parquet as pq

        files, at = _folder(self.path)
        name, writer, rows = f"staged/{self.producer}-{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if batch.num_rows and writer is None:
                    files.create_dir(f"{at}/staged", recursive=True)
                    writer = pq.ParquetWriter(f"{at}/{name}", batch.schema, filesystem=files)
                if writer is not None:
                    writer.write_batch(batch)
                    rows += batch.num_rows
        except Exception:
            if writer is not None:
                writer.close()
                files.delete_file(f"{at}/{name}")
            raise
        if writer is not None:
            writer.close()
        return Staged(name if rows else None, rows)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        files, at = _folder(self.path)
        files.create_dir(f"{at}/commits", recursive=True)
        where = f"{at}/commits/{self.producer}-{batchId:012d}.json"
        if files.get_file_info(where).is_file:
            return self.abort(messages, batchId)
        held = [m for m in messages if m is not None and m.file]
        new = f"{at}/commits/.{uuid.uuid4().hex}"
        with files.open_output_stream(new) as out:
            out.write(json.dumps({"files": [m.file for m in held], "rows": sum(m.rows for m in held)}).encode())
        files.move(new, where)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        files, at = _folder(self.path)
        for m in messages:
            if m is not None and m.file and files.get_file_info(f"{at}/{m.file}").is_file:
                files.delete_file(f"{at}/{m.file}")


class TwoPhaseSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "two_phase"

    def streamWriter(self, schema: StructType, overwrite: bool) -> TwoPhaseWriter:
        return TwoPhaseWriter(self.options["path"], self.options.get("producer", "stream"))


def _commits(folder: Folder) -> list[dict]:
    return [json.loads(folder.read(f"commits/{n}")) for n in folder.names("commits") if n.endswith(".json") and not n.startswith(".")]


def committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all commits."""
    files = [f"{path}/{f}" for c in _commits(Folder(spark, path)) for f in c["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete staged files that no commit names; no micro-batch may be under way. Returns their number."""
    folder = Folder(spark, path)
    named = {f for c in _commits(folder) for f in c["files"]}
    gone = [f"staged/{n}" for n in folder.names("staged") if f"staged/{n}" not in named]
    for name in gone:
        folder.remove(name)
    return len(gone)
