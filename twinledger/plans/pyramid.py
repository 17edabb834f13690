"""Reconciliation from stored fingerprints, which new files bring up to date.

    root/of=.../entries/run=N/month=YYYY-MM/   second, key, docs, lake_any, lake_exact, file
    root/of=.../levels/run=N/month=YYYY-MM/    level, bucket, docs, index_keys, lake_keys, xor_a, xor_b
    root/of=.../log/run=N/                     what run N added, removed and built

A call reads the files that no run has recorded, reduces each to a row per second and
key, and builds the buckets of all five levels anew for the months that these files, or
files gone since, have rows in. Other months keep theirs. Distinct keys do not add up
from seconds to months; so each row of a key tells at which levels it is the key's first
in its bucket, by one look back along the key's rows of the month, and a bucket's number
and fingerprint of keys are sums over the rows that are first there. One aggregation
gives all levels. Two buckets hold the same keys if 128 bits of exclusive-or agree.

The log is the last thing a run writes: one that dies leaves folders that are never read,
and the next call does its work again. Files are taken to be written once, and one call
at a time to bring one root up to date.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import ENTITY_MARKER, LEVELS, bucket_start, epoch_ts, quadrimester_of, year_month
from twinledger.operators import filters, joins, sketches
from twinledger.operators.lists import PRUNE_VALUES
from twinledger.plans.reconciliation import (
    INDEX_SIDE,
    LAKE_SIDE,
    LEAF_THRESHOLD,
    Reconciliation,
    by_key,
    check_choices,
    one_sided,
)
from twinledger.session import materialize
from twinledger.sources import params_hash, read_index, read_stage
from twinledger.sources.ledger import new_run, read_if_present



def _schema(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_TEXT, _LONG, _FLAG, _TIME = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType()
_LOG = _schema(event=_TEXT, name=_TEXT, run=_LONG)
_ENTRIES = _schema(
    second=_TIME, key=_TEXT, docs=_LONG, lake_any=_FLAG, lake_exact=_FLAG, file=_TEXT, run=_LONG, month=_TEXT
)
_LEVELS = _schema(
    **{"level": _TEXT, "bucket": _TIME, "docs": _LONG, "index_keys": _LONG, "lake_keys": _LONG},
    **{"xor_a": _LONG, "xor_b": _LONG, "run": _LONG, "month": _TEXT},
)
_QUADRIMESTER = "^[0-9]{4}-T[123]$"


def _home(root: str, entity: str, marker: str) -> str:
    return f"{root}/of={params_hash(entity=entity, marker=marker)}"


def _state(spark: SparkSession, home: str) -> tuple[dict[str, int], set[tuple[str, int]], dict[str, int]]:
    """Files that count and the run that added them; all (file, run) ever added; months and the run that built them."""
    live: dict[str, int] = {}
    added: set[tuple[str, int]] = set()
    built: dict[str, int] = {}
    # A row per file and month of each run: names only.
    for row in sorted(read_if_present(spark, f"{home}/log", _LOG).collect(), key=lambda r: r.run):
        if row.event == "added":
            live[row.name] = row.run
            added.add((row.name, row.run))
        elif row.event == "removed":
            live.pop(row.name, None)
        else:
            built[row.name] = row.run
    return live, added, built


def _read_again(scan: DataFrame, path: str, files: list[str]) -> DataFrame:
    """These files of a scan of `path`, each row with its file."""
    some = scan.sparkSession.read.schema(scan.schema).option("basePath", path)
    # Listings escape names as in addresses; readers take them as they are.
    return some.parquet(*map(unquote, files)).withColumn("file", F.input_file_name())


def _index_rows(docs: DataFrame, entity: str, marker: str) -> DataFrame:
    return filters.with_entity_phrase(docs.where("start_ts is not null"), entity, marker).select(
        bucket_start("second", F.col("start_ts")).alias("second"),
        "key",
        F.lit(1).cast("bigint").alias("docs"),
        F.lit(False).alias("lake_any"),
        F.lit(False).alias("lake_exact"),
        "file",
    )


def _lake_rows(stage: DataFrame, entity: str) -> DataFrame:
    ts = epoch_ts(F.col("start_time"))
    dated = filters.by_entity(stage, entity).where(
        F.col("quadrimester").rlike(_QUADRIMESTER) & (F.date_format(ts, "yyyy") == F.substring("quadrimester", 1, 4))
    )
    return dated.select(
        ts.alias("second"),
        "key",
        F.lit(0).cast("bigint").alias("docs"),
        F.lit(True).alias("lake_any"),
        (F.col("quadrimester") == quadrimester_of(ts)).alias("lake_exact"),
        "file",
    )


def _entries(spark: SparkSession, home: str, runs: set[int], live: dict[str, int], added: set[tuple[str, int]]) -> DataFrame:
    """Stored entries of the files that count."""
    stored = read_if_present(spark, f"{home}/entries", _ENTRIES).where(F.col("run").isin(*sorted(runs)))
    return _without(stored, sorted((f, r) for f, r in added if live.get(f) != r))


def _without(stored: DataFrame, dead: list[tuple[str, int]]) -> DataFrame:
    if not dead:
        return stored
    if len(dead) <= PRUNE_VALUES:
        return stored.where(~F.concat_ws("|", "run", "file").isin(*(f"{run}|{file}" for file, run in dead)))
    return stored.join(stored.sparkSession.createDataFrame(dead, "file string, run long"), ["file", "run"], "left_anti")


def _in_months(stored: DataFrame, months: list[str]) -> DataFrame:
    if len(months) <= PRUNE_VALUES:
        return stored.where(F.col("month").isin(*months))
    listed = stored.sparkSession.createDataFrame([(m,) for m in months], "month string")
    return stored.join(listed, "month", "left_semi")


def level_rows(entries: DataFrame) -> DataFrame:
    """month, level, bucket, docs, index_keys, lake_keys, xor_a, xor_b of all levels.

    `lake_keys` counts lake_any at month level and lake_exact below; the fingerprint is
    zero if index and lake (lake_exact) hold the same keys. Entries without a key count
    as documents only.
    """
    rows = entries.groupBy("month", "second", "key").agg(
        F.sum("docs").alias("docs"), F.bool_or("lake_any").alias("lake_any"), F.bool_or("lake_exact").alias("lake_exact")
    )
    held = F.col("key").isNotNull()
    # Rows without a key, which may be a third of all, take no part in the look back.
    along = Window.partitionBy("month", "key").orderBy("second").rowsBetween(Window.unboundedPreceding, -1)
    sides = {"index": F.col("docs") > 0, "any": F.col("lake_any"), "exact": F.col("lake_exact")}
    last = {side: F.last(F.when(on, F.col("second")), ignorenulls=True).over(along) for side, on in sides.items()}
    a, b = sketches.hashes(F.col("key"))
    keyed = rows.where(held).select("*", *(x.alias(f"last_{side}") for side, x in last.items()), a.alias("a"), b.alias("b"))

    def first(side: str, level: str) -> Column:
        before = F.col(f"last_{side}")
        return sides[side] & (before.isNull() | (bucket_start(level, before) != bucket_start(level, F.col("second"))))

    def number(on: Column) -> Column:
        return F.when(on, 1).otherwise(0).cast("bigint")

    def bucket(level: str, keys: bool) -> Column:
        index, lake = (first("index", level), first("any" if level == "month" else "exact", level)) if keys else (F.lit(False),) * 2
        # A key that is first on both sides leaves the fingerprint as it is.
        odd = (index != first("exact", level)) if keys else F.lit(False)
        none = F.lit(0).cast("bigint")
        return F.struct(
            F.lit(level).alias("level"),
            bucket_start(level, F.col("second")).alias("bucket"),
            F.col("docs").alias("docs"),
            number(index).alias("index_keys"),
            number(lake).alias("lake_keys"),
            (F.when(odd, F.col("a")).otherwise(none) if keys else none).alias("xor_a"),
            (F.when(odd, F.col("b")).otherwise(none) if keys else none).alias("xor_b"),
        )

    found = [
        part.select("month", F.explode(F.array(*(bucket(level, keys) for level in LEVELS))).alias("x"))
        for part, keys in ((keyed, True), (rows.where(~held), False))
    ]
    return (
        found[0].unionByName(found[1])
        .groupBy("month", "x.level", "x.bucket")
        .agg(
            *(F.sum(f"x.{name}").alias(name) for name in ("docs", "index_keys", "lake_keys")),
            *(F.bit_xor(f"x.{name}").alias(name) for name in ("xor_a", "xor_b")),
        )
    )


def grow_pyramid(
    spark: SparkSession,
    docs_path: str,
    stage_path: str,
    entity: str,
    root: str,
    marker: str = ENTITY_MARKER,
    by_month: bool = False,
) -> tuple[list[str], list[str]]:
    """Bring the stored buckets of one entity up to date: the files read and the months built."""
    home = _home(root, entity, marker)
    live, added, built = _state(spark, home)
    docs, stage = read_index(spark, docs_path, by_month=by_month), filters.by_entity(read_stage(spark, stage_path), entity)
    of_docs, of_stage = set(docs.inputFiles()), set(stage.inputFiles())
    fresh_docs, fresh_stage = sorted(of_docs - live.keys()), sorted(of_stage - live.keys())
    gone = sorted(live.keys() - of_docs - of_stage)
    if not (fresh_docs or fresh_stage or gone):
        return [], []
    run = new_run()
    months: set[str] = set()
    if gone:
        old = _entries(spark, home, {live[f] for f in gone}, live, added)
        lost = spark.createDataFrame([(f,) for f in gone], "file string")
        months |= {r.month for r in old.join(lost, "file", "left_semi").select("month").distinct().collect()}
    parts = []
    if fresh_docs:
        parts.append(_index_rows(_read_again(docs, docs_path, fresh_docs), entity, marker))
    if fresh_stage:
        parts.append(_lake_rows(_read_again(stage, stage_path, fresh_stage), entity))
    if parts:
        reduced = reduce(DataFrame.unionByName, parts).groupBy("second", "key", "file").agg(
            F.sum("docs").alias("docs"), F.bool_or("lake_any").alias("lake_any"), F.bool_or("lake_exact").alias("lake_exact")
        )
        reduced = reduced.withColumn("month", year_month(F.col("second")))
        place = f"{home}/entries/run={run}"
        reduced.hint("rebalance", F.col("month")).write.partitionBy("month").parquet(place)
        new = read_if_present(spark, f"{home}/entries", _ENTRIES).where(F.col("run") == run)
        months |= {r.month for r in new.select("month").distinct().collect()}
    now = {f: r for f, r in live.items() if f in of_docs or f in of_stage} | {f: run for f in (*fresh_docs, *fresh_stage)}
    known = added | {(f, run) for f in (*fresh_docs, *fresh_stage)}
    if months:
        entries = _in_months(_entries(spark, home, set(now.values()), now, known), sorted(months))
        levels = level_rows(entries).hint("rebalance", F.col("month"))
        levels.write.partitionBy("month").parquet(f"{home}/levels/run={run}")
    events = [("added", f) for f in (*fresh_docs, *fresh_stage)] + [("removed", f) for f in gone]
    events += [("built", m) for m in sorted(months)]
    spark.createDataFrame(events, "event string, name string").coalesce(1).write.parquet(f"{home}/log/run={run}")
    return [*fresh_docs, *fresh_stage], sorted(months)


def reconcile_stored(
    spark: SparkSession,
    entity: str,
    years: list[int],
    root: str,
    threshold: int = LEAF_THRESHOLD,
    left_metric: str = "docs",
    marker: str = ENTITY_MARKER,
    sides: tuple[str, str] = (INDEX_SIDE, LAKE_SIDE),
    compare: str = "keys",
) -> Reconciliation:
    """What `reconcile` reports, of the files that `grow_pyramid` has stored.

    Buckets are compared by their stored numbers alone; rows are read only of months in
    which some bucket is listed by key.
    """
    check_choices(left_metric, compare)
    home = _home(root, entity, marker)
    live, added, built = _state(spark, home)
    wanted = [f"{int(y):04d}-{n:02d}" for y in years for n in range(1, 13)]
    months = [m for m in wanted if m in built]
    newest = F.concat_ws("|", "run", "month").isin(*(f"{built[m]}|{m}" for m in months))
    stored = read_if_present(spark, f"{home}/levels", _LEVELS)
    stored = stored.where(F.col("run").isin(*sorted({built[m] for m in months})) & F.col("month").isin(*months) & newest)
    left = F.col("docs") if left_metric == "docs" else F.col("index_keys")
    other_keys = (F.col("xor_a") != 0) | (F.col("xor_b") != 0)
    differs = (left != F.col("lake_keys")) | (other_keys if compare == "keys" else F.lit(False))
    differing = materialize(
        stored.where(differs).select(
            *("level", "bucket", left.alias("left_n"), F.col("lake_keys").alias("right_n"), "month"),
            ((F.col("level") == LEVELS[-1]) | (left < threshold)).alias("leaf"),
        ),
        "differing",
    )
    fronts, above = [], None
    for level, parent in zip(LEVELS, (None, *LEVELS)):
        here = differing.where(F.col("level") == level)
        if above is not None:
            here = joins.under_frontier(here.withColumnRenamed("bucket", "at"), F.col("at"), above.where(~F.col("leaf")), parent)
            here = here.withColumnRenamed("at", "bucket")
        above = materialize(here, f"frontier-{level}")
        fronts.append(above)
    front = reduce(DataFrame.unionByName, fronts)
    # At most twelve labels per requested year and level; they prune the entries' folders.
    listed: dict[str, list[str]] = {}
    for row in front.where("leaf").select("level", "month").distinct().collect():
        listed.setdefault(row.level, []).append(row.month)
    entries = _entries(spark, home, set(live.values()), live, added)
    outstanding = [
        one_sided(
            by_key(
                joins.under_frontier(
                    _in_months(entries, sorted(listed.get(level, []))), F.col("second"), at.where("leaf"), level
                ),
                bucket_start(level, F.col("second")),
            ),
            level,
            sides,
        )
        for level, at in zip(LEVELS, fronts)
        if level in listed or level == LEVELS[0]
    ]
    mismatches = front.select("level", "bucket", "left_n", "right_n", "leaf")
    return Reconciliation(reduce(DataFrame.unionByName, outstanding), mismatches)
