"""An append-only table of files that takes each run once, as a Spark data source.

    spark.dataSource.register(Ledger)
    df.write.format("ledger").mode("append").options(path=..., run="2012-01-03").save()

Tasks write Parquet files and report them; the driver then names all of a run's files in one ledger entry, which
is put in place by a rename. A task that ran twice leaves a file that no entry names, a run that failed leaves none,
and a run whose name has an entry already adds nothing. ``path`` has to be of a kind that Arrow can write to, and reached by all
executors. Streams use it from ``foreachBatch``, with the batch's number in the run's name.
"""

import hashlib
import json
from dataclasses import dataclass
from uuid import uuid4

import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FILES, ENTRIES = "files", "ledger"


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: a file, if it had any row."""

    file: str | None
    rows: int


def _entry(run: str) -> str:
    return f"{ENTRIES}/{hashlib.sha256(run.encode()).hexdigest()}.json"


def _exists(target, path) -> bool:
    return target.get_file_info(path).type != fs.FileType.NotFound


class Ledger(DataSource):
    @classmethod
    def name(cls):
        return "ledger"

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("a ledger is appended to only")
        return LedgerWriter(self.options, schema)


class LedgerWriter(DataSourceArrowWriter):
    def __init__(self, options, schema):
        self.path, self.run, self.schema = options["path"].rstrip("/"), options["run"], schema.json()

    def write(self, iterator) -> Written:
        target, folder = fs.FileSystem.from_uri(self.path)
        name, out, rows = f"{FILES}/{uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if batch.num_rows:
                    if out is None:
                        target.create_dir(f"{folder}/{FILES}", recursive=True)
                        out = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=target, compression="snappy")
                    out.write_batch(batch)
                    rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(name if rows else None, rows)

    def commit(self, messages):
        target, folder = fs.FileSystem.from_uri(self.path)
        final = f"{folder}/{_entry(self.run)}"
        if _exists(target, final):
            self._discard(target, folder, messages)
            return
        target.create_dir(f"{folder}/{ENTRIES}", recursive=True)
        found = [m for m in messages if m is not None and m.file]
        entry = {"run": self.run, "files": [m.file for m in found], "rows": sum(m.rows for m in found), "schema": self.schema}
        # Readers look for .json only, so they see the whole entry or none.
        part = f"{final}.{uuid4().hex}"
        with target.open_output_stream(part) as out:
            out.write(json.dumps(entry).encode())
        target.move(part, final)

    def abort(self, messages):
        target, folder = fs.FileSystem.from_uri(self.path)
        self._discard(target, folder, messages)

    @staticmethod
    def _discard(target, folder, messages):
        for message in messages:
            if message is not None and message.file and _exists(target, f"{folder}/{message.file}"):
                target.delete_file(f"{folder}/{message.file}")


def append_once(df: DataFrame, path, run: str):
    """Add the rows under the name of a run, unless that name is in the ledger: then they are not even computed."""
    target, folder = fs.FileSystem.from_uri(path)
    if _exists(target, f"{folder.rstrip('/')}/{_entry(run)}"):
        return
    df.sparkSession.dataSource.register(Ledger)
    df.write.format("ledger").mode("append").options(path=path, run=run).save()


def entries(path) -> list[dict]:
    """The ledger: run, files, rows and schema of every run that counts."""
    target, folder = fs.FileSystem.from_uri(path)
    if not _exists(target, f"{folder}/{ENTRIES}"):
        return []
    found = [f.path for f in target.get_file_info(fs.FileSelector(f"{folder}/{ENTRIES}")) if f.path.endswith(".json")]
    read = []
    for file in sorted(found):
        with target.open_input_stream(file) as source:
            read.append(json.loads(source.read()))
    return sorted(read, key=lambda e: e["run"])


def scan_ledger(spark: SparkSession, path) -> DataFrame:
    """The rows of all runs in the ledger, in the columns of the first one by name."""
    named = entries(path)
    if not named:
        raise ValueError(f"no run is in the ledger of {path}")
    schema = T.StructType.fromJson(json.loads(named[0]["schema"]))
    files = [f"{path.rstrip('/')}/{f}" for e in named for f in e["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
