"""A file format of its own as a Spark data source: Arrow files and a manifest of those that were committed."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

MANIFEST = "manifest.json"


@dataclass
class Part(InputPartition):
    path: str


@dataclass
class Done(WriterCommitMessage):
    path: str
    rows: int


class ArrowParts(DataSource):
    """``format("arrow_parts")``: option ``path`` names a folder in a store that pyarrow and all executors reach.

    A part counts only once the manifest lists it, so that files of failed or repeated tasks are never read. Every part is
    a partition of its own; with a schema given to the reader only its columns are read from the files.
    """

    @classmethod
    def name(cls) -> str:
        return "arrow_parts"

    def _manifest(self) -> dict:
        store, path = fs.FileSystem.from_uri(self.options["path"])
        with store.open_input_stream(f"{path}/{MANIFEST}") as f:
            return json.loads(f.read())

    def schema(self) -> StructType:
        return StructType.fromJson(self._manifest()["schema"])

    def reader(self, schema: StructType) -> PartsReader:
        return PartsReader(self.options["path"], [p["path"] for p in self._manifest()["parts"]], schema.names)

    def writer(self, schema: StructType, overwrite: bool) -> PartsWriter:
        return PartsWriter(self.options["path"], schema.json())


class PartsReader(DataSourceReader):
    def __init__(self, folder: str, parts: list[str], names: list[str]) -> None:
        self.folder, self.parts, self.names = folder, parts, names

    def partitions(self) -> list[Part]:
        return [Part(p) for p in self.parts]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(self.folder)
        with store.open_input_file(f"{folder}/{partition.path}") as f:
            names = pa.ipc.open_file(f).schema.names
            options = pa.ipc.IpcReadOptions(included_fields=[names.index(n) for n in self.names])
            file = pa.ipc.open_file(f, options=options)
            for i in range(file.num_record_batches):
                yield file.get_batch(i).select(self.names)


class PartsWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, schema: str) -> None:
        self.folder, self.schema = folder, schema

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Done:
        store, folder = fs.FileSystem.from_uri(self.folder)
        store.create_dir(folder, recursive=True)
        name, rows, out = f"part-{uuid.uuid4().hex}.arrow", 0, None
        with store.open_output_stream(f"{folder}/{name}") as f:
            for batch in iterator:
                out = out or pa.ipc.new_file(f, batch.schema)
                out.write_batch(batch)
                rows += batch.num_rows
            if out:
                out.close()
        return Done(name if out else "", rows)

    def commit(self, messages: list[Done | None]) -> None:
        store, folder = fs.FileSystem.from_uri(self.folder)
        parts = [{"path": m.path, "rows": m.rows} for m in messages if m and m.path]
        with store.open_output_stream(f"{folder}/{MANIFEST}") as f:
            f.write(json.dumps({"schema": json.loads(self.schema), "parts": parts}).encode())

    def abort(self, messages: list[Done | None]) -> None:
        store, folder = fs.FileSystem.from_uri(self.folder)
        for m in messages:
            if m and m.path:
                store.delete_file(f"{folder}/{m.path}")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArrowParts)
