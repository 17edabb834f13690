"""Keep the latest row per source id and month, verify, publish."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger import schemas
from twinledger.functions import epoch_ts, literal_tags
from twinledger.functions.text import UNSAFE_IN_NAME
from twinledger.operators import aggregates, filters, windows
from twinledger.session import materialize
from twinledger.sources import (
    create_dedup_table,
    mark_done,
    params_hash,
    read_dedup,
    read_ledger,
    repair_table,
    write_flat,
    write_quadrimester,
    write_report,
)

JOB = "migrate"
SCOPES = {"month": ["quadrimester", "month", "source_id"], "quadrimester": ["quadrimester", "source_id"]}

_log = logging.getLogger(__name__)


def table_name(entity: str) -> str:
    """One table per entity; characters a table name cannot hold become '_'."""
    return f"migration_{re.sub(UNSAFE_IN_NAME, '_', entity)}_monthly"


def temp_path(root: str, entity: str) -> str:
    return f"{root}/temps/reporting_entity={entity}/_tmp"


def final_path(root: str, entity: str, label: str) -> str:
    return f"{root}/reporting_entity={entity}/MIGRATED/{label}"


def dedup(stage: DataFrame, entity: str, labels: list[str], scope: str = "month") -> DataFrame:
    """Latest row per source id within its month (or quadrimester).

    Only rows dated inside the quadrimester they are filed under take part. All
    quadrimesters and months go through one window; its group limit runs before
    the shuffle, so a source id with most of the rows is cut down in place.
    """
    rows = filters.by_quadrimesters(filters.by_entity(stage, entity), labels)
    ts = epoch_ts(F.col("start_time"))
    year, quadrimester, month = literal_tags(ts)
    dated = rows.where(F.col("quadrimester") == quadrimester).select(*schemas.DEDUP_COLUMNS, year, "quadrimester", month)
    return filters.latest_only(windows.rank_latest(dated, SCOPES[scope]))


def verify(kept: DataFrame, stage: DataFrame, entity: str, labels: list[str]) -> DataFrame:
    """Compare distinct source ids of the deduplicated rows with the lake.

    The lake side is not filtered by date: a source id filed under the wrong
    quadrimester makes the check fail, which is its purpose. `note` marks rows
    left over by ids that span months.
    """
    temp = aggregates.verify_counts(filters.by_quadrimesters(kept, labels))
    lake = aggregates.verify_counts(filters.by_quadrimesters(filters.by_entity(stage, entity), labels))
    pair = temp.select(
        "quadrimester",
        F.col("total_rows").alias("temp_total_rows"),
        F.col("distinct_sources").alias("temp_distinct_sources"),
    ).join(
        lake.select("quadrimester", F.col("distinct_sources").alias("stage2_distinct_sources")),
        "quadrimester",
        "full",
    )
    counts = pair.fillna(0, ["temp_total_rows", "temp_distinct_sources", "stage2_distinct_sources"])
    delta = F.col("temp_distinct_sources") - F.col("stage2_distinct_sources")
    return counts.withColumn("delta", delta).select(
        "*",
        F.when(F.col("delta") == 0, "pass").otherwise("mismatch").alias("status"),
        (F.col("temp_total_rows") != F.col("temp_distinct_sources")).alias("note"),
    )


def verify_published(kept: DataFrame, places: dict[str, str]) -> DataFrame:
    """quadrimester, kept_rows, published_rows, status: published files read back and compared
    with the rows they were written from, as multisets (status `pass` or `mismatch`).

    `kept`: deduplicated rows. `places`: the folder of each quadrimester; one for which
    nothing was kept must be empty.
    """
    spark = kept.sparkSession
    checksum = aggregates.content_checksum(list(schemas.DEDUP_COLUMNS))
    schema = T.StructType([f for f in schemas.DEDUP.fields if f.name in schemas.DEDUP_COLUMNS])
    read = [
        spark.read.schema(schema).parquet(path).withColumn("quadrimester", F.lit(label)) for label, path in places.items()
    ]
    written = reduce(DataFrame.unionByName, read).groupBy("quadrimester").agg(*checksum)
    wanted = filters.by_quadrimesters(kept, list(places)).groupBy("quadrimester").agg(*checksum)
    names = [c for c in wanted.columns if c != "quadrimester"]
    pair = wanted.withColumnsRenamed({c: f"kept_{c}" for c in names}).join(written, "quadrimester", "full")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"kept_{c}")) for c in names))
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(name) for c, name in (("kept_n", "kept_rows"), ("n", "published_rows"))]
    return pair.select("quadrimester", *counts, F.when(same, "pass").otherwise("mismatch").alias("status"))


def mismatch_report(verified: DataFrame, entity: str) -> DataFrame:
    """Failed verifications under the report's column names."""
    return verified.where(F.col("status") == "mismatch").select(
        "quadrimester",
        F.lit(entity).alias("reporting_entity"),
        "temp_distinct_sources",
        "temp_total_rows",
        "stage2_distinct_sources",
        "delta",
        F.current_timestamp().alias("timestamp"),
    )


def _attempt(work: Callable[[str], None], labels: list[str]) -> dict[str, str]:
    """Run one Spark job per label side by side; return label -> error of those
    that failed. A failure never stops the others."""
    errors: dict[str, str] = {}

    def guarded(label: str) -> None:
        try:
            work(label)
        except Exception as e:  # noqa: BLE001 - becomes the label's outcome
            _log.warning("quadrimester %s failed: %s", label, e)
            errors[label] = str(e)

    if labels:
        with ThreadPoolExecutor(len(labels)) as pool:
            list(pool.map(guarded, labels))
    return errors


def _dedup_wave(stage: DataFrame, entity: str, wave: list[str], scope: str) -> Callable[[str], DataFrame]:
    """The deduplicated rows of each quadrimester of a wave, from one pass over the lake.

    They are stored by quadrimester, so that its job reads one folder. If that pass fails,
    each quadrimester is read on its own, and fails alone.
    """
    try:
        rows = dedup(stage, entity, wave, scope).hint("rebalance", F.col("quadrimester"))
        kept = materialize(rows, "dedup-wave", ["quadrimester"])
    except Exception as e:  # noqa: BLE001 - shows again in the quadrimesters concerned
        _log.warning("quadrimesters %s could not be read together: %s", wave, e)
        return lambda label: dedup(stage, entity, [label], scope)
    return lambda label: filters.by_quadrimester(kept, label)


def _migrate_wave(
    spark: SparkSession, stage: DataFrame, entity: str, wave: list[str], root: str, scope: str
) -> dict[str, tuple[str, str | None]]:
    """Write, verify and publish a few quadrimesters; outcome and error of each."""
    table = table_name(entity)
    temp = temp_path(root, entity)
    kept = _dedup_wave(stage, entity, wave, scope)
    failed = _attempt(lambda label: write_quadrimester(kept(label), temp, label), wave)
    written = [label for label in wave if label not in failed]
    passed, mismatched = written, []
    if written:
        repair_table(spark, table)
        # One row per label of the wave. A label without rows anywhere passes.
        found = verify(spark.table(table), stage, entity, written)
        rows = found.collect()
        mismatched = [r.quadrimester for r in rows if r.status != "pass"]
        passed = [label for label in written if label not in mismatched]
        if mismatched:
            kept_rows = spark.createDataFrame(rows, found.schema)
            write_report(mismatch_report(kept_rows, entity), f"{root}/mismatched-quadrimesters")
    failed |= _attempt(
        lambda label: write_flat(
            read_dedup(spark, table, label), final_path(root, entity, label)
        ),
        passed,
    )
    places = {label: final_path(root, entity, label) for label in passed if label not in failed}
    differ: dict[str, str] = {}
    if places:
        # One row per label; read back from the files, before anything is recorded as done.
        found = verify_published(spark.table(table), places)
        rows = found.where(F.col("status") != "pass").collect()
        differ = {r.quadrimester: f"kept {r.kept_rows} rows, published {r.published_rows}: content differs" for r in rows}
        if rows:
            wrong = spark.createDataFrame(rows, found.schema).withColumn("reporting_entity", F.lit(entity))
            write_report(wrong, f"{root}/mismatched-content")
    return {
        label: ("failed", failed[label])
        if label in failed
        else ("mismatch" if label in mismatched or label in differ else "published", differ.get(label))
        for label in wave
    }


def migrate(
    spark: SparkSession,
    stage: DataFrame,
    entity: str,
    years: list[int],
    root: str,
    quadrimesters: list[str] | None = None,
    scope: str = "month",
    wave: int = 3,
) -> DataFrame:
    """Migrate every requested quadrimester not published before.

    Returns quadrimester, outcome (`published`, `mismatch`, `failed`, `done`)
    and error. Quadrimesters go in waves of `wave`: deduplicated in one pass, written
    side by side, one job each, then verified together, published, read back, and recorded. So a failure
    costs one quadrimester, a lost driver at most one wave, and since every
    write replaces its folder, repeating changes nothing.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope {scope!r} is none of {sorted(SCOPES)}")
    labels = filters.check_quadrimesters(quadrimesters, years)
    params = params_hash(entity=entity, scope=scope)
    # At most one ledger row per requested label comes back.
    done = read_ledger(spark, root, JOB, params).where(F.col("unit").isin(*labels))
    finished = {row.unit for row in done.collect()}
    outcomes: dict[str, tuple[str, str | None]] = {q: ("done", None) for q in labels if q in finished}
    pending = [q for q in labels if q not in finished]
    if pending:
        create_dedup_table(spark, table_name(entity), temp_path(root, entity))
    for at in range(0, len(pending), wave):
        result = _migrate_wave(spark, stage, entity, pending[at : at + wave], root, scope)
        published = [(q,) for q, (outcome, _) in result.items() if outcome == "published"]
        if published:
            mark_done(spark.createDataFrame(published, "unit string"), root, JOB, params)
        outcomes |= result
    return spark.createDataFrame(
        [(q, *outcomes[q]) for q in labels], "quadrimester string, outcome string, error string"
    )
