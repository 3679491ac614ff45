"""Tables that are written, audited and then committed: readers follow a log of commits.

    <table>/_data/_write=<write>/run_year=2012/part-….parquet     rows, seen only once a commit names them
    <table>/_commits/part-….parquet                            one file per commit

A commit is one appended file, so readers see all of it or nothing. Each of its rows names one partition
and the write that holds its rows; a replaced partition left without rows has no write. The
rows of a partition are those of its last replacement and of all commits after it. Writes that failed, were
refused or are replaced stay where they are until ``vacuum``.
"""

import json
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.sinks.tables import PARTITION, rebalanced

LOG, DATA, WRITE = "_commits", "_data", "_write"
REPLACE, APPEND = "replace", "append"
LOG_SCHEMA = (
    "commit BIGINT, id STRING, mode STRING, part STRING, write STRING, rows BIGINT, columns STRING, report STRING, at TIMESTAMP"
)


class Refused(ValueError):
    """An audit found a write unfit; the table is as it was."""


@dataclass(frozen=True)
class Staged:
    """Rows that are written but not seen: their folder, schema, and number by partition (as text; None: null)."""

    table: str
    write: str
    schema: T.StructType
    by: str
    rows: dict

    @property
    def total(self) -> int:
        return sum(self.rows.values())

    def read(self, spark: SparkSession) -> DataFrame:
        return _read(spark, self.table, self.schema, self.by, [(p, self.write) for p in self.rows])


def stage(df: DataFrame, table, by=PARTITION, clustered=False) -> Staged:
    """Write the rows where no reader looks, and count what arrived from the files' own footers.

    ``clustered`` tells that the rows of a partition already are together.
    """
    table, write = table.rstrip("/"), uuid4().hex
    rows = df if clustered else rebalanced(df, by)
    folder = f"{table}/{DATA}/{WRITE}={write}"
    rows.write.partitionBy(by).parquet(folder)
    typed = df.sparkSession.read.schema(df.schema).parquet(folder)
    # One row per partition.
    counted = typed.groupBy(F.col(by).cast("string").alias("part")).count().collect()
    return Staged(table, write, df.schema, by, {r.part: r["count"] for r in counted})


def commit(spark: SparkSession, staged: Staged, mode=REPLACE, parts=(), id=None, report=None) -> dict:
    """Make the staged rows part of the table, and keep ``report`` with the commit.

    ``replace`` drops what the table held in the partitions that the rows are in and in ``parts``; ``append`` adds to it.
    An append whose ``id`` is committed already adds nothing. Returns the report of the commit that counts.
    """
    log = _log(spark, staged.table)
    known = committed(spark, staged.table, id) if id is not None else None
    if known is not None and mode == APPEND:
        return known
    number = 1 + max((r.commit for r in log), default=0)
    named = dict(staged.rows)
    if mode == REPLACE:
        named = {**{str(p): 0 for p in parts}, **named}
    kept = {"rows": staged.total, **(report or {})}
    common = json.dumps(kept, default=str), datetime.now(timezone.utc)
    rows = [
        (number, id or staged.write, mode, part, staged.write if n else None, n, staged.schema.json(), *common)
        for part, n in sorted(named.items(), key=str)
    ]
    # A run without any row is kept too: a partition of its own that nobody reads.
    rows = rows or [(number, id or staged.write, APPEND, None, None, 0, staged.schema.json(), *common)]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{staged.table}/{LOG}")
    return kept


def _log(spark: SparkSession, table) -> list:
    """The rows of the log in order: a few per commit."""
    folder = f"{table.rstrip('/')}/{LOG}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return []
    return sorted(spark.read.schema(LOG_SCHEMA).parquet(folder).collect(), key=lambda r: (r.commit, r.at, r.id))


def committed(spark: SparkSession, table, id) -> dict | None:
    """The report of the last commit of a run, if it has one."""
    own = [r for r in _log(spark, table) if r.id == id]
    return json.loads(own[-1].report) if own else None


def live(log) -> list[tuple]:
    """``(partition, write)`` of all rows that count, by the log in order."""
    held = {}
    for r in log:
        held[r.part] = [*([] if r.mode == REPLACE else held.get(r.part, [])), r.write]
    return [(part, write) for part, own in held.items() for write in own if write is not None]


def _read(spark, table, schema, by, named) -> DataFrame:
    if not named:
        return spark.createDataFrame([], schema)
    null = "__HIVE_DEFAULT_PARTITION__"
    folders = [f"{table}/{DATA}/{WRITE}={write}/{by}={null if part is None else part}" for part, write in named]
    # The base path makes both folder levels columns; the write is of no interest.
    reader = spark.read.schema(schema).option("basePath", f"{table}/{DATA}")
    return reader.parquet(*folders).select(*schema.names)


def scan(spark: SparkSession, table, by=PARTITION) -> DataFrame:
    """The committed rows, in the columns of the last commit; earlier files that lack one give NULL there."""
    table = table.rstrip("/")
    log = _log(spark, table)
    if not log:
        raise ValueError(f"nothing is committed in {table}")
    return _read(spark, table, T.StructType.fromJson(json.loads(log[-1].columns)), by, live(log))


def history(spark: SparkSession, table) -> DataFrame:
    """``(commit, id, mode, part, rows, report, at)``: what each commit did to which partition."""
    return spark.read.schema(LOG_SCHEMA).parquet(f"{table.rstrip('/')}/{LOG}").select("commit", "id", "mode", "part", "rows", "report", "at")


def vacuum(spark: SparkSession, table, older=timedelta(days=7)) -> list[str]:
    """Delete the writes that no commit makes part of the table and that are ``older``; returns their names.

    A reader that began before a replacement still needs the replaced rows, and a writer at work has rows that
    are not committed: ``older`` has to exceed the longest run.
    """
    table = table.rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{DATA}")
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(path):
        return []
    kept = {write for _, write in live(_log(spark, table))}
    least = (datetime.now(timezone.utc) - older).timestamp() * 1000
    gone = []
    for found in system.listStatus(path):
        write = found.getPath().getName().removeprefix(f"{WRITE}=")
        if write not in kept and found.getModificationTime() <= least:
            system.delete(found.getPath(), True)
            gone.append(write)
    return sorted(gone)
