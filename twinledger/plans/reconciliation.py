"""Where in time do the two copies differ, and by which keys?

Both copies of one entity are reduced to one narrow table with a row per
(second, key) and side markers: one shuffle combines them, one more gathers the
months in files. Every level of the drill-down then reads that table: month, day,
hour, minute, second. A level looks only below buckets that differ, so there are
at most five rounds, whatever the number of differing buckets. Buckets differ by
their counts, or by their keys where equal counts hide other keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import (
    ENTITY_MARKER,
    LEVELS,
    bucket_start,
    epoch_ts,
    quadrimester_of,
    window_of,
    window_text,
    year_month,
)
from twinledger.functions.calendar import SPECIAL_BUCKETS
from twinledger.operators import filters, joins, sketches
from twinledger.operators.lists import NARROW_ROWS
from twinledger.session import materialize
from twinledger.sources import mark_done, params_hash, read_ledger
from twinledger.sources.ledger import read_if_present

# A differing bucket with fewer index documents than this is compared by key.
LEAF_THRESHOLD = 10_000

# Fixed names of the two sides in the report.
INDEX_SIDE = "ES_ONLY"
LAKE_SIDE = "ATHENA_ONLY"

JOB = "reconcile"
_FOUND = "level string, window_start string, window_end_exclusive string, source string, key string"

LEFT_METRICS = ("docs", "distinct")
COMPARE = ("keys", "counts")


@dataclass(frozen=True)
class Reconciliation:
    outstanding: DataFrame  # level, window_start, window_end_exclusive, source, key
    mismatches: DataFrame  # level, bucket, left_n, right_n, leaf


def _combined(
    docs: DataFrame, stage: DataFrame, entity: str, years: list[int], marker: str
) -> DataFrame:
    """second, key, docs, lake_any, lake_exact: a row per second and key."""
    return by_key(_stacked(docs, stage, entity, years, marker), F.col("second"), "second")


def _stacked(
    docs: DataFrame, stage: DataFrame, entity: str, years: list[int], marker: str
) -> DataFrame:
    """Rows of both copies: second, key, docs, lake_any, lake_exact.

    lake_any: some row of that year's quadrimesters. lake_exact: some row of
    exactly the quadrimester its time falls in. The month level counts the
    former, deeper levels and key lists the latter.
    """
    wanted = [int(y) for y in years]
    start, end = f"{min(wanted):04d}-01-01", f"{max(wanted) + 1:04d}-01-01"
    dated = filters.in_window_ms(docs, start, end).where(F.year("start_ts").isin(*wanted))
    left = filters.with_entity_phrase(dated, entity, marker).select(
        bucket_start("second", F.col("start_ts")).alias("second"),
        "key",
        F.lit(1).cast("bigint").alias("docs"),
        F.lit(False).alias("lake_any"),
        F.lit(False).alias("lake_exact"),
    )
    labels = [f"{y:04d}-T{n}" for y in wanted for n in (1, 2, 3)]
    ts = epoch_ts(F.col("start_time"))
    right = (
        filters.by_quadrimesters(filters.by_entity(stage, entity), labels)
        .where(F.date_format(ts, "yyyy") == F.substring("quadrimester", 1, 4))
        .select(
            ts.alias("second"),
            "key",
            F.lit(0).cast("bigint").alias("docs"),
            F.lit(True).alias("lake_any"),
            (F.col("quadrimester") == quadrimester_of(ts)).alias("lake_exact"),
        )
    )
    return left.unionByName(right)


def by_key(rows: DataFrame, bucket: Column, name: str = "bucket") -> DataFrame:
    return rows.groupBy(bucket.alias(name), "key").agg(
        F.sum("docs").alias("docs"),
        F.bool_or("lake_any").alias("lake_any"),
        F.bool_or("lake_exact").alias("lake_exact"),
    )


def one_sided(by_key: DataFrame, level: str, sides: tuple[str, str]) -> DataFrame:
    start, end = window_of(level, F.col("bucket"))
    in_index = F.col("docs") > 0
    return by_key.where(F.col("key").isNotNull() & (in_index != F.col("lake_exact"))).select(
        F.lit(level).alias("level"),
        window_text(start).alias("window_start"),
        window_text(end).alias("window_end_exclusive"),
        F.when(in_index, sides[0]).otherwise(sides[1]).alias("source"),
        "key",
    )


def check_choices(left_metric: str, compare: str) -> None:
    if left_metric not in LEFT_METRICS:
        raise ValueError(f"left_metric {left_metric!r} is none of {LEFT_METRICS}")
    if compare not in COMPARE:
        raise ValueError(f"compare {compare!r} is none of {COMPARE}")


def reconcile(
    docs: DataFrame,
    stage: DataFrame,
    entity: str,
    years: list[int],
    threshold: int = LEAF_THRESHOLD,
    left_metric: str = "docs",
    marker: str = ENTITY_MARKER,
    sides: tuple[str, str] = (INDEX_SIDE, LAKE_SIDE),
    compare: str = "keys",
) -> Reconciliation:
    """Drill from months to seconds where the copies differ; list one-sided keys.

    The index side counts documents (`left_metric="docs"`) or distinct keys
    ("distinct"); the lake side counts distinct keys. With `compare="keys"` a
    bucket also differs if one side holds a key that the other lacks, so none
    goes unnoticed. With "counts" buckets of equal counts are not opened.
    """
    check_choices(left_metric, compare)
    narrow_rows = _combined(docs, stage, entity, years, marker).withColumn(
        "month", year_month(F.col("second"))
    )
    table = materialize(narrow_rows.hint("rebalance", F.col("month")), "reconcile", ["month"])
    second, held = F.col("second"), F.col("key").isNotNull()

    rows = table
    fronts: list[tuple[str, DataFrame, list[str]]] = []
    for level in LEVELS:
        lake = F.col("lake_any") if level == "month" else F.col("lake_exact")
        left = F.sum("docs") if left_metric == "docs" else F.count_if(held & (F.col("docs") > 0))
        # Rows are by key here, so whether the sets of keys differ needs no fingerprint.
        differs = held & ((F.col("docs") > 0) != F.col("lake_exact"))
        others = F.bool_or(differs) if compare == "keys" else F.lit(False)
        counts = (
            by_key(rows, bucket_start(level, second))
            .groupBy("bucket")
            .agg(left.alias("left_n"), F.count_if(held & lake).alias("right_n"), others.alias("others"))
        )
        leaf = F.lit(True) if level == LEVELS[-1] else F.col("left_n") < threshold
        differing = counts.where((F.col("left_n") != F.col("right_n")) | F.col("others")).drop("others")
        front = materialize(differing.withColumn("leaf", leaf), f"frontier-{level}")
        # At most twelve labels per requested year; they prune the table's folders.
        found = front.select(year_month(F.col("bucket")).alias("m"), "leaf").distinct().collect()
        leaf_months, drill_months = ([r.m for r in found if r.leaf is kind] for kind in (True, False))
        fronts.append((level, front, leaf_months))
        if not drill_months:
            break
        below = table.where(F.col("month").isin(*drill_months))
        rows = joins.under_frontier(below, second, front.where(~F.col("leaf")), level)

    outstanding = [
        one_sided(
            by_key(
                joins.under_frontier(table.where(F.col("month").isin(*months)), second, front.where("leaf"), level),
                bucket_start(level, second),
            ),
            level,
            sides,
        )
        for level, front, months in fronts
    ]
    mismatches = [front.select(F.lit(level).alias("level"), "*") for level, front, _ in fronts]
    return Reconciliation(
        reduce(DataFrame.unionByName, outstanding), reduce(DataFrame.unionByName, mismatches)
    )


def run_reconcile(
    docs: DataFrame, stage: DataFrame, entity: str, years: list[int], root: str, **options
) -> tuple[DataFrame, DataFrame]:
    """Reconcile year by year and store what is found; years done before are kept.

    A year's findings replace its folder as a whole and are recorded afterwards,
    per entity and options. A year that fails is reported and does not stop the
    rest; the next call tries it again. Returns the findings of the years asked
    for, and year, outcome (`done`, `failed`), error.
    """
    spark = docs.sparkSession
    params = params_hash(entity=entity, **options)
    out = f"{root}/{JOB}/params={params}"
    asked = sorted({int(y) for y in years})
    units = read_ledger(spark, root, JOB, params).where(F.col("unit").isin(*map(str, asked)))
    finished = {int(row.unit) for row in units.collect()}
    errors: dict[int, str] = {}
    for year in asked:
        if year in finished:
            continue
        try:
            found = reconcile(docs, stage, entity, [year], **options).outstanding
            found.write.mode("overwrite").parquet(f"{out}/year={year:04d}")
            mark_done(spark.createDataFrame([(str(year),)], "unit string"), root, JOB, params)
        except Exception as e:  # noqa: BLE001 - reported as the year's outcome
            errors[year] = f"{type(e).__name__}: {e}"
    schema = T.StructType.fromDDL(f"{_FOUND}, year string")
    stored = read_if_present(spark, out, schema).where(
        F.col("year").isin(*(f"{y:04d}" for y in asked if y not in errors))
    )
    rows = [(y, "failed" if y in errors else "done", errors.get(y)) for y in asked]
    return stored, spark.createDataFrame(rows, "year int, outcome string, error string")


def reconcile_exact(
    docs: DataFrame,
    stage: DataFrame,
    entity: str,
    years: list[int],
    level: str = "month",
    marker: str = ENTITY_MARKER,
    sides: tuple[str, str] = (INDEX_SIDE, LAKE_SIDE),
) -> DataFrame:
    """Every one-sided key of every bucket, whether or not its counts differ."""
    rows = _combined(docs, stage, entity, years, marker)
    return one_sided(by_key(rows, bucket_start(level, F.col("second"))), level, sides)


def reconcile_sketched(
    docs: DataFrame,
    stage: DataFrame,
    entity: str,
    years: list[int],
    level: str = "month",
    marker: str = ENTITY_MARKER,
    sides: tuple[str, str] = (INDEX_SIDE, LAKE_SIDE),
    max_rows: int = NARROW_ROWS,
    first_cells: int = sketches.FIRST_CELLS,
    most_cells: int = sketches.MOST_CELLS,
) -> DataFrame:
    """What `reconcile_exact` gives, for copies that differ in little.

    Both copies' rows are stored as they are, bucket by bucket sketched against each
    other, and only keys that a sketch names are compared. A key that one side holds
    more often than the other is named too, and dropped by that comparison. Buckets
    with too many differences for a sketch are compared whole.
    """
    held = F.col("key").isNotNull() & ((F.col("docs") > 0) | F.col("lake_exact"))
    a, b = sketches.hashes(F.col("key"))
    rows = _stacked(docs, stage, entity, years, marker).where(held).select(
        bucket_start(level, F.col("second")).alias("bucket"),
        *("key", "docs", "lake_any", "lake_exact"),
        F.when(F.col("docs") > 0, 1).otherwise(-1).cast("bigint").alias("sign"),
    )
    rows = materialize(rows, "both-copies")
    found, stuck = sketches.differences(rows.select("bucket", "key", "sign"), first_cells, most_cells)
    hashed = rows.select("*", a.alias("a"), b.alias("b"))
    if found.count() <= max_rows:
        found = F.broadcast(found)
    named = hashed.join(found, ["bucket", "a", "b"], "left_semi").drop("a", "b")
    whole = rows.join(stuck, "bucket", "left_semi")
    return one_sided(by_key(named.unionByName(whole), F.col("bucket")), level, sides)


def mistagged_rows(stage: DataFrame) -> DataFrame:
    """Lake rows filed under another quadrimester than their time falls in."""
    belongs = quadrimester_of(epoch_ts(F.col("start_time")))
    return stage.where(
        ~F.col("quadrimester").isin(*SPECIAL_BUCKETS) & (F.col("quadrimester") != belongs)
    ).withColumn("expected_quadrimester", belongs)


def undated_rows(stage: DataFrame) -> DataFrame:
    """Lake rows whose start_time is not a usable number of milliseconds."""
    return stage.where(epoch_ts(F.col("start_time")).isNull())
