"""A sink that drains partitions to files outside Spark's own writers and commits them at once.

``df.write.format("file_drain").option("path", folder).mode("append").save()`` writes each partition
as one file of JSON lines or CSV below ``folder/data/run=<id>``. The run counts once its manifest, a
single small file that lists those files with their rows, is in ``folder/manifests``; readers start
from the manifests. A failed run removes its folder and leaves no manifest, and files of attempts that
were not committed are removed when the run ends.

Paths are plain paths or URIs of any file system that pyarrow knows; all executors must see them.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv as pa_csv
from pyarrow import fs as pa_fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "file_drain"

# Looks for files of tasks that were being stopped when a run failed, and seconds between them.
LATE_LOOKS = 8
LATE_PAUSE = 0.25

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Drained(WriterCommitMessage):
    file: str
    rows: int


def _open(path: str) -> tuple[pa_fs.FileSystem, str]:
    return pa_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa_fs.LocalFileSystem(), path)


def _json_lines(batch: pa.RecordBatch) -> bytes:
    """One object per row; times as ISO text, so any loader reads them."""
    columns = {
        f.name: pc.strftime(batch[f.name], "%Y-%m-%dT%H:%M:%S") if pa.types.is_timestamp(f.type) else batch[f.name]
        for f in batch.schema
    }
    lists = {name: column.to_pylist() for name, column in columns.items()}
    rows = (dict(zip(lists, row)) for row in zip(*lists.values()))
    return "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows).encode()


def _csv(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    pa_csv.write_csv(batch, out, pa_csv.WriteOptions(include_header=False))
    return out.getvalue().to_pybytes()


FORMATS = {"json": _json_lines, "csv": _csv}


class DrainWriter(DataSourceArrowWriter):
    def __init__(self, path: str, kind: str, run: str | None = None):
        self.path, self.kind, self.run = path.rstrip("/"), kind, run or uuid.uuid4().hex

    @property
    def folder(self) -> str:
        return f"{self.path}/data/run={self.run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Drained:
        task = TaskContext.get()
        system, folder = _open(self.folder)
        system.create_dir(folder, recursive=True)
        name, rows = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.{self.kind}", 0
        with system.open_output_stream(f"{folder}/{name}") as out:
            for batch in iterator:
                out.write(FORMATS[self.kind](batch))
                rows += batch.num_rows
        return Drained(name, rows)

    def commit(self, messages: list[Drained | None]) -> None:
        system, folder = _open(self.folder)
        kept = {m.file: m.rows for m in messages if m is not None}
        system.create_dir(folder, recursive=True)
        for info in system.get_file_info(pa_fs.FileSelector(folder)):
            if info.base_name not in kept:
                system.delete_file(info.path)
        _, manifests = _open(f"{self.path}/manifests")
        system.create_dir(manifests, recursive=True)
        files = [{"file": f"data/run={self.run}/{f}", "rows": n} for f, n in sorted(kept.items())]
        with system.open_output_stream(f"{manifests}/writing-{self.run}") as out:
            out.write(json.dumps({"run": self.run, "format": self.kind, "files": files}).encode())
        system.move(f"{manifests}/writing-{self.run}", f"{manifests}/{self.run}.json")

    def abort(self, messages: list[Drained | None]) -> None:
        system, folder = _open(self.folder)
        if system.get_file_info(folder).type != pa_fs.FileType.NotFound:
            system.delete_dir(folder)


class DrainSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> DrainWriter:
        if overwrite:
            raise ValueError("file_drain appends runs; it does not overwrite")
        kind = self.options.get("kind", "json")
        if kind not in FORMATS:
            raise ValueError(f"kind must be one of {sorted(FORMATS)}")
        return DrainWriter(self.options["path"], kind, self.options.get("run"))


def drain(df: DataFrame, path: str, kind: str = "json") -> None:
    """Drain all partitions of ``df`` below ``path`` as one run."""
    df.sparkSession.dataSource.register(DrainSource)
    run = uuid.uuid4().hex
    try:
        df.write.format(NAME).option("path", path).option("kind", kind).option("run", run).mode("append").save()
    except Exception:
        # Spark does not wait for tasks that it stops: one of them may create its file after the abort.
        writer = DrainWriter(path, kind, run)
        for _ in range(LATE_LOOKS):
            time.sleep(LATE_PAUSE)
            with suppress(OSError, pa.ArrowInvalid):  # the run's own failure is the one to tell
                writer.abort([])
        raise


def drained_runs(spark: SparkSession, path: str) -> DataFrame:
    """``(run, format, file, rows)``: the files of all committed runs."""
    schema = "run string, format string, files array<struct<file: string, rows: long>>"
    return spark.read.schema(schema).json(f"{path}/manifests/*.json").selectExpr("run", "format", "inline(files)")


def read_drained(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of all committed runs in JSON lines; the schema is the reader's."""
    listed = drained_runs(spark, path).filter("format = 'json' AND rows > 0").select("file")
    files = [f"{path}/{r.file}" for r in listed.collect()]  # a name per file, as any listing
    return spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)
