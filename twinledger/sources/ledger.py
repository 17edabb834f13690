"""Outcome tables and unit ledgers: what is done, and what to redo.

A ledger row says that one unit of work (a year bucket, a quadrimester) is
finished for one job and one set of parameters. An outcome table holds one row
per key or id and run. Both are append-only Parquet, never rewritten; an outcome
table of many runs may be merged into a snapshot beside it.
"""

from __future__ import annotations

import hashlib
import json
import secrets
import time
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger import schemas
from twinledger.session import materialize


# Runs started by a call, as opposed to those of a stream.
BATCH_FEED = "batch"

_MERGED = T.StructType([T.StructField("file", T.StringType()), T.StructField("gen", T.LongType())])


def params_hash(**params) -> str:
    """Short, stable name for a set of job parameters."""
    text = json.dumps(params, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, root: str, job: str, params: str) -> DataFrame:
    """Finished units of one job under one set of parameters."""
    rows = read_if_present(spark, f"{root}/ledger", schemas.LEDGER)
    return rows.where((F.col("job") == job) & (F.col("params") == params)).select("unit").distinct()


def mark_done(units: DataFrame, root: str, job: str, params: str) -> None:
    """Append finished units. Call only after their output is committed."""
    units.select(
        F.col("unit").cast("string"),
        F.current_timestamp().alias("recorded_at"),
        F.lit(job).alias("job"),
        F.lit(params).alias("params"),
    ).write.mode("append").partitionBy("job", "params").parquet(f"{root}/ledger")


def new_run() -> int:
    """A run number that no other call gets, later ones higher: microseconds and chance."""
    return time.time_ns() // 1_000 * 1_000 + secrets.randbelow(1_000)


def append_outcomes(
    outcomes: DataFrame, path: str, run: int | None = None, feed: str = BATCH_FEED, part: int = 0
) -> int:
    """Write outcomes of a run (a new one unless given) and return its number.

    Rows go to feed=F/run=N/part=P/outcome=...; a folder that exists is refused,
    so two calls on one path never replace each other's rows.
    """
    run = new_run() if run is None else run
    outcomes.write.mode("errorifexists").partitionBy("outcome").parquet(
        f"{path}/feed={feed}/run={run}/part={part}"
    )
    return run


def _placed(schema: T.StructType) -> T.StructType:
    place = [
        ("feed", T.StringType()),
        ("run", T.LongType()),
        ("part", T.IntegerType()),
        ("outcome", T.StringType()),
    ]
    names = {name for name, _ in place}
    return T.StructType(
        [f for f in schema.fields if f.name not in names]
        + [T.StructField(name, kind) for name, kind in place]
    )


def _merged(spark: SparkSession, path: str) -> tuple[int | None, set[str]]:
    """The snapshot that counts, and the files whose rows it holds: names only."""
    rows = read_if_present(spark, f"{path}-compacted/files", _MERGED).collect()
    last = max((r.gen for r in rows), default=None)
    return last, {r.file for r in rows if r.gen == last}


def _read_merged(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, set[str], set[str]]:
    """Rows of an outcome table, the files that its snapshot holds, and those written since."""
    full = _placed(schema)
    rows = read_if_present(spark, path, full)
    gen, merged = _merged(spark, path)
    if gen is None:
        return rows, set(), set(rows.inputFiles())
    later = set(rows.inputFiles()) - merged
    found = spark.read.schema(full).parquet(f"{path}-compacted/rows/gen={gen}")
    if later:
        # Listings escape names as in addresses; readers take them as they are.
        some = spark.read.schema(full).option("basePath", path).parquet(*map(unquote, sorted(later)))
        found = found.unionByName(some)
    return found, merged, later


def read_outcomes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All runs of an outcome table, with columns `feed`, `run`, `part` and `outcome`.

    Files that `compact_outcomes` has merged are read from its snapshot.
    """
    return _read_merged(spark, path, schema)[0]


def compact_outcomes(spark: SparkSession, path: str, schema: T.StructType, on: str) -> int:
    """Merge the files written so far into a snapshot of few files, sorted by `on`; the number of files merged.

    Every row is kept, so readers get what they got before. The snapshot lies in
    `{path}-compacted`, and the list of files that it holds is written after it: a call
    that dies in between changes nothing. Runs that go on meanwhile are read beside it.
    Merged files are not deleted, as older readers may still have them; they may go
    once no job that began before this call is left.
    """
    rows, merged, later = _read_merged(spark, path, schema)
    if not later:
        return 0
    gen = new_run()
    ranged = rows.repartitionByRange(on).sortWithinPartitions(on)
    ranged.write.parquet(f"{path}-compacted/rows/gen={gen}")
    files = spark.createDataFrame([(f,) for f in sorted(merged | later)], "file string")
    files.coalesce(1).write.parquet(f"{path}-compacted/files/gen={gen}")
    return len(later)


def done_keys(outcomes: DataFrame, on: str, done: list[str]) -> DataFrame:
    """Values with a finished outcome in any run."""
    return outcomes.where(F.col("outcome").isin(*done)).select(on).distinct()


def completed_ids(outcomes: DataFrame, on: str, failed: str = "failed") -> DataFrame:
    """Ids whose latest run left no failed row.

    An id may have several rows per run (one per key); one failed key keeps the
    whole id open.
    """
    return (
        outcomes.groupBy(on)
        .agg(F.max(F.struct("run", (F.col("outcome") == failed).alias("bad"))).alias("last"))
        .where(~F.col("last.bad"))
        .select(on)
    )


def current_outcomes(outcomes: DataFrame, on: str) -> DataFrame:
    """Rows of each id's latest run."""
    last = materialize(outcomes.groupBy(on).agg(F.max("run").alias("run")), "latest-runs")
    return outcomes.join(last, [on, "run"], "left_semi")


def ledger_union(*parts: DataFrame) -> DataFrame:
    """Done-set held in several tables."""
    return reduce(DataFrame.unionByName, parts).distinct()
