"""Source id -> key(s) in the index -> quadrimester -> rows in the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import SOURCE_MARKER, quadrimester_of_key, safe_error
from twinledger.operators import filters, joins, ordering, windows
from twinledger.operators.lists import NARROW_ROWS
from twinledger.session import materialize
from twinledger.sources import (
    append_outcomes,
    completed_ids,
    mark_done,
    read_ledger,
    read_outcomes,
)

JOB = "source_lookup"

OUTCOMES = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("quadrimester", T.StringType()),
        T.StructField("lake_count", T.LongType()),
        T.StructField("stage", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

# Stage name and message recorded for a key that carries no date.
DERIVE_STAGE = "QUADRIMESTER_DERIVE"
DERIVE_ERROR = "no year and month at the start of the key: "


def lookup_sources(
    ids: DataFrame,
    docs: DataFrame,
    stage: DataFrame,
    entity: str,
    start=None,
    end_exclusive=None,
    marker: str = SOURCE_MARKER,
    keys_per_id: int | None = None,
    max_rows: int = NARROW_ROWS,
) -> DataFrame:
    """One row per (id, document): its key, quadrimester and lake count.

    All documents count unless `start` or `end_exclusive` bounds their time.

    outcome is `resolved`; `failed` for a key without a readable date;
    `unresolved` for an id no document names (one row, no key). The narrow
    (id, key) pairs are written to the scratch area once, because searching the
    texts is the costly part and three later steps need the pairs.
    """
    listed = ids.select("source_id").distinct()
    texts = filters.with_text_key(filters.in_start_range(docs, start, end_exclusive))
    pairs = joins.phrase_pairs(listed, texts, marker, max_rows)
    if keys_per_id is not None:
        pairs = windows.limit_per_id(pairs, keys_per_id)
    pairs = materialize(
        pairs.select("source_id", "key", quadrimester_of_key(F.col("key")).alias("quadrimester")),
        "lookup-pairs",
    )
    dated = F.col("quadrimester").isNotNull()
    found = joins.lake_counts(pairs, stage, entity, max_rows).select(
        "source_id",
        "key",
        "quadrimester",
        F.when(dated, F.col("lake_count")).alias("lake_count"),
        F.when(~dated, F.lit(DERIVE_STAGE)).alias("stage"),
        F.when(~dated, F.concat(F.lit(DERIVE_ERROR), "key")).alias("error"),
        F.when(dated, "resolved").otherwise("failed").alias("outcome"),
    )
    nothing = F.lit(None).cast("string")
    # One aggregation of both: a task holds one table of ids, and sorts neither side.
    flags = ids.select("source_id", F.lit(False).alias("named")).unionByName(
        pairs.select("source_id", F.lit(True).alias("named"))
    )
    unresolved = flags.groupBy("source_id").agg(F.bool_or("named").alias("named")).where(~F.col("named")).select(
        "source_id",
        nothing.alias("key"),
        nothing.alias("quadrimester"),
        F.lit(None).cast("bigint").alias("lake_count"),
        nothing.alias("stage"),
        nothing.alias("error"),
        F.lit("unresolved").alias("outcome"),
    )
    return found.unionByName(unresolved)


def run_source_lookup(
    ids: DataFrame,
    docs: DataFrame,
    stage: DataFrame,
    entity: str,
    path: str,
    limit: int | None = None,
    **options,
) -> DataFrame:
    """Look up ids not finished before, append by outcome, return all runs.

    An id with any failed key in its latest run is looked up again. A run counts
    only once its write is complete and recorded: a part of it could hold the
    resolved row of an id without the failed one.
    """
    spark = ids.sparkSession
    ledger = f"{path}.runs"

    def recorded() -> DataFrame:
        runs = read_ledger(spark, ledger, JOB, "runs").select(F.col("unit").cast("bigint").alias("run"))
        return read_outcomes(spark, path, OUTCOMES).join(runs, "run", "left_semi")

    done = completed_ids(recorded(), "source_id")
    pending = materialize(ordering.limit_inputs(ids, done, "source_id", limit), "pending-ids")
    run = append_outcomes(lookup_sources(pending, docs, stage, entity, **options), path)
    mark_done(spark.createDataFrame([(str(run),)], "unit string"), ledger, JOB, "runs")
    return recorded()


def lookup_report(outcomes: DataFrame) -> DataFrame:
    """Resolved rows under the report's column names."""
    return outcomes.where(F.col("outcome") == "resolved").select(
        "source_id", "key", "quadrimester", F.col("lake_count").alias("athena_count")
    )


def failed_report(outcomes: DataFrame) -> DataFrame:
    """Failed rows under the report's column names."""
    return outcomes.where(F.col("outcome") == "failed").select(
        "source_id", "stage", safe_error(F.col("error")).alias("error")
    )
