"""A stored index of in-text markers, grown by new files only.

    root/postings/run=N/marker=.../month=YYYY-MM/   value, doc_id, key, times, file
    root/files/run=N/                               the files that run N has indexed

A call reads the texts of files that no run has recorded, writes their postings to a
run folder of its own, and records the files after that. A run that dies is not
recorded: its folder is never read, and the next call indexes those files again. Two
calls at once may index the same files; the lowest run of each file counts. Postings
of files that are no longer in the index copy are left out. Files are taken to be
written once, as Spark does.
"""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger import schemas
from twinledger.functions import ENTITY_MARKER, SOURCE_MARKER
from twinledger.operators import postings
from twinledger.operators.lists import PRUNE_VALUES
from twinledger.sources.ledger import new_run, read_if_present
from twinledger.sources.readers import read_index

MARKERS = (SOURCE_MARKER, ENTITY_MARKER)

_FILES = T.StructType([T.StructField("file", T.StringType()), T.StructField("run", T.LongType())])
_POSTINGS = T.StructType(
    [
        T.StructField("value", T.StringType()),
        *(f for f in schemas.INDEX_DOCS.fields if f.name != "content"),
        T.StructField("file", T.StringType()),
        T.StructField("run", T.LongType()),
        T.StructField("marker", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)


def _listed(spark: SparkSession, docs_path: str, by_month: bool) -> set[str]:
    """The files of the index copy: names only, from the listing that planning a scan makes."""
    return set(read_index(spark, docs_path, by_month=by_month).inputFiles())


def _recorded(spark: SparkSession, root: str) -> dict[str, list[int]]:
    """The runs that have recorded each file."""
    runs: dict[str, list[int]] = {}
    for row in read_if_present(spark, f"{root}/files", _FILES).collect():
        runs.setdefault(row.file, []).append(row.run)
    return runs


def new_texts(spark: SparkSession, docs_path: str, root: str, by_month: bool = False) -> tuple[DataFrame | None, list[str]]:
    """Documents of the files that no run has recorded, and those files; (None, []) if all are."""
    fresh = sorted(_listed(spark, docs_path, by_month) - _recorded(spark, root).keys())
    if not fresh:
        return None, []
    schema = read_index(spark, docs_path, by_month=by_month).schema
    # Listings escape names as in addresses; readers take them as they are.
    return spark.read.schema(schema).option("basePath", docs_path).parquet(*map(unquote, fresh)), fresh


def grow_markers(
    spark: SparkSession, docs_path: str, root: str, markers: Iterable[str] = MARKERS, by_month: bool = False
) -> list[str]:
    """Index the files that are new in the index copy, and return them."""
    docs, fresh = new_texts(spark, docs_path, root, by_month)
    if docs is None:
        return []
    run = new_run()
    names = [f.name for f in schemas.INDEX_DOCS.fields]
    # The place of a row is known in the scan only, before anything else is done to it.
    placed = docs.select(*names, F.input_file_name().alias("file"))
    found = postings.named(placed, markers).withColumn("month", F.date_format("start_ts", "yyyy-MM"))
    # Dealt out as one row per document, whatever number of values it names. Equal and like
    # values stand together in a file, which makes it small and lets readers skip parts of it.
    rows = postings.spread(found.hint("rebalance", F.col("month"))).sortWithinPartitions("marker", "month", "value", "doc_id")
    rows.write.option("compression", "zstd").partitionBy("marker", "month").parquet(f"{root}/postings/run={run}")
    _record(spark, root, run, fresh)
    return fresh


def _record(spark: SparkSession, root: str, run: int, files: list[str]) -> None:
    rows = spark.createDataFrame([(f,) for f in files], "file string")
    rows.coalesce(1).write.parquet(f"{root}/files/run={run}")


def read_markers(spark: SparkSession, root: str, docs_path: str | None = None, by_month: bool = False) -> DataFrame:
    """Stored postings: value, doc_id, key, start_ts, archived_ts, file, run, marker, month.

    With `docs_path`, postings of files that the copy no longer has are left out. They take
    the place of documents in `plans.source_multiplicity`, `lookup_sources` and `reconcile`.
    """
    recorded = _recorded(spark, root)
    listed = _listed(spark, docs_path, by_month) if docs_path else recorded.keys()
    runs = sorted({run for found in recorded.values() for run in found})
    dead = [
        (file, run) for file, found in recorded.items() for run in found if run != min(found) or file not in listed
    ]
    if not runs:
        return spark.createDataFrame([], _POSTINGS)
    stored = read_if_present(spark, f"{root}/postings", _POSTINGS).where(F.col("run").isin(*runs))
    if not dead:
        return stored
    if len(dead) <= PRUNE_VALUES:
        return stored.where(~F.concat_ws("|", "run", "file").isin(*(f"{run}|{file}" for file, run in dead)))
    return stored.join(spark.createDataFrame(dead, "file string, run long"), ["file", "run"], "left_anti")
