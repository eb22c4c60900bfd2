"""A Spark data source that writes batches as transactions: `df.write.format("spanlake")`, and reads what was committed.

A write has a batch id. Its tasks write files of their own below a folder of the write; when all are done, one small file that
names them is put in place, and only that makes them visible. A write that fails leaves nothing that is read, and what it wrote
is deleted (a task that still ran then may leave a file, which `clean` deletes); a batch that is there already is left as it is, so sending it again is no danger. Files are on any file system that
pyarrow reads, which the driver and all executors share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructField, StructType

FORMAT = "spanlake"
#: Rows of a batch that a reader hands over at once.
READ_ROWS = 10_000


def place(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _exists(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


@dataclass
class Written(WriterCommitMessage):
    """A task's file, none where it had no rows, and its rows."""

    file: str | None
    rows: int


class BatchWriter(DataSourceArrowWriter):
    """Writes one batch."""

    def __init__(self, path: str, batch: str, schema: StructType):
        self.path, self.batch, self.schema = path.rstrip("/"), batch, to_arrow_schema(schema, prefers_large_types=False)
        self.folder = f"data/{batch}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = place(self.path)
        context = TaskContext.get()
        name = f"{self.folder}/part-{context.partitionId():05d}-{context.taskAttemptId()}.parquet"
        writer, rows = None, 0
        try:
            for batch in iterator:
                if writer is None:
                    fs.create_dir(f"{base}/{self.folder}", recursive=True)
                    writer = pq.ParquetWriter(fs.open_output_stream(f"{base}/{name}"), batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Written(name if writer is not None else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        """Makes the files of the tasks that count visible, all at once, unless the batch is there; what other attempts left goes."""
        fs, base = place(self.path)
        told = f"{base}/commits/{self.batch}.json"
        if _exists(fs, told):
            self._drop(fs, base)
            return
        files = sorted(m.file for m in messages if m and m.file)
        if _exists(fs, f"{base}/{self.folder}"):
            for info in fs.get_file_info(pafs.FileSelector(f"{base}/{self.folder}")):
                if f"{self.folder}/{info.base_name}" not in files:
                    fs.delete_file(info.path)
        fs.create_dir(f"{base}/commits", recursive=True)
        temp = f"{base}/commits/.{uuid.uuid4().hex}"
        with fs.open_output_stream(temp) as out:
            out.write(json.dumps({"batch": self.batch, "files": files, "rows": sum(m.rows for m in messages if m), "schema": self.schema.serialize().to_pybytes().hex()}).encode())
        fs.move(temp, told)

    def abort(self, messages: list[Written | None]) -> None:
        self._drop(*place(self.path))

    def _drop(self, fs: pafs.FileSystem, base: str) -> None:
        if _exists(fs, f"{base}/{self.folder}"):
            fs.delete_dir(f"{base}/{self.folder}")


class CommittedFile(InputPartition):
    """A file of a committed batch."""

    def __init__(self, file: str, batch: str):
        super().__init__(file)
        self.file, self.batch = file, batch


class BatchReader(DataSourceReader):
    """Reads the files of committed batches, a partition each."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path.rstrip("/"), to_arrow_schema(schema, prefers_large_types=False)

    def partitions(self) -> list[CommittedFile]:
        return [CommittedFile(f, told["batch"]) for told in commits(self.path) for f in told["files"]]

    def read(self, partition: CommittedFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no batch has rows
            return
        fs, base = place(self.path)
        with fs.open_input_file(f"{base}/{partition.file}") as source:
            for batch in pq.ParquetFile(source).iter_batches(READ_ROWS):
                there = set(batch.schema.names)
                columns = [batch.column(f.name).cast(f.type) if f.name in there else pa.nulls(batch.num_rows, f.type) for f in self.schema]
                yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


def commits(path: str) -> list[dict]:
    """What the committed batches of a folder say of themselves, by batch; a line of the driver a batch."""
    fs, base = place(path.rstrip("/"))
    if not _exists(fs, f"{base}/commits"):
        return []
    found = sorted(x.path for x in fs.get_file_info(pafs.FileSelector(f"{base}/commits")) if x.base_name.endswith(".json"))
    out = []
    for file in found:
        with fs.open_input_stream(file) as source:
            out.append(json.loads(source.readall()))
    return out


def clean(path: str) -> int:
    """Deletes what no commit names, when no write runs; returns how many folders that were."""
    fs, base = place(path.rstrip("/"))
    if not _exists(fs, f"{base}/data"):
        return 0
    named = {f.split("/")[1] for told in commits(path) for f in told["files"]}
    lost = [x.path for x in fs.get_file_info(pafs.FileSelector(f"{base}/data")) if x.base_name not in named]
    for folder in lost:
        fs.delete_dir(folder)
    return len(lost)


class Batches(DataSource):
    """Options: path, and to write batch, a name that tells the batch."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        told = commits(self.options["path"])
        if not told:
            raise ValueError(f"{self.options['path']} has no committed batch")
        found = pa.unify_schemas([pa.ipc.read_schema(pa.py_buffer(bytes.fromhex(x["schema"]))) for x in told])
        return StructType([StructField(f.name, f.dataType, True) for f in from_arrow_schema(found)])  # a batch may lack a column

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        batch = self.options.get("batch", "")
        if overwrite:
            raise ValueError("batches are added and never overwritten: use the mode append")
        if not batch or batch.startswith(".") or "/" in batch:
            raise ValueError("the option batch must name the batch that is written")
        return BatchWriter(self.options["path"], batch, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Batches)
