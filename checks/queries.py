"""Registered queries, each beside the SQL DuckDB runs for the same answer."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import ENTITY, YEARS, Fixtures, duckdb_with
from twinledger import functions as fn
from twinledger import plans, schemas, sources
from twinledger.operators import aggregates, filters, joins, ordering, sets, windows
from twinledger.plans.migration import table_name
from twinledger.plans.multiplicity import SOURCE_OUTCOMES
from twinledger.plans.replaying import DONE as REPLAY_DONE
from twinledger.plans.replaying import OUTCOMES as REPLAY_OUTCOMES
from twinledger.session import materialize, scratch_path
from twinledger.sources.ledger import read_outcomes
from twinledger.streaming import replay_new_files

BUILDERS: dict[str, Callable[[Fixtures], DataFrame]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: tuple[str, ...], sql: str | None):
    """Register a function of Fixtures; `sql` may use the named views."""

    def wrap(build: Callable[[Fixtures], DataFrame]):
        BUILDERS[name] = build
        QUERIES[name] = lambda spark, sf_dir: build(Fixtures(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = f"{duckdb_with(*views)}\n{sql.strip()}" if views else sql.strip()
        return build

    return wrap


# DuckDB spellings used again and again.
TS = "make_timestamp(TRY_CAST(start_time AS BIGINT) // 1000 * 1000000)"
MARK = "list_distinct(regexp_extract_all(content, '(?:^|[^A-Za-z0-9_-]){m}:[ \\t]*(\\S+)', 1))"
SRC_VALUES = MARK.format(m="X-SOURCE-ID")
ENT_VALUES = MARK.format(m="X-REPORTING-ENTITY")


def quad(ts: str) -> str:
    return f"strftime({ts}, '%Y') || '-T' || CAST(CAST(CEIL(month({ts}) / 4.0) AS INT) AS STRING)"


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def micros(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


KEY_MONTH = (
    "CASE WHEN regexp_matches(key, '^[0-9]{4}/[0-9]{2}/') "
    "THEN substr(key, 1, 4) || '-' || substr(key, 6, 2) ELSE 'all' END"
)
KEY_QUAD = (
    "CASE WHEN regexp_matches(key, '^[0-9]{4}/(0[1-9]|1[0-2])/') THEN substr(key, 1, 4) || '-T' || "
    "CAST(CAST(CEIL(CAST(substr(key, 6, 2) AS INT) / 4.0) AS INT) AS STRING) END"
)
LABELS = {
    "month": "%Y-%m",
    "day": "%Y-%m-%d",
    "hour": "%Y-%m-%dT%H",
    "minute": "%Y-%m-%dT%H:%M",
    "second": "%Y-%m-%dT%H:%M:%S",
}
STAGE_COLUMNS = ", ".join(schemas.STAGE.fieldNames())
YEAR_QUADS = ", ".join(f"'{y}-T{n}'" for y in YEARS for n in (1, 2, 3))
PAIRS = f"pairs AS (SELECT * EXCLUDE content, UNNEST({SRC_VALUES}) AS source_id FROM index_docs)"
BUCKET = (
    "CASE WHEN quadrimester IN ('pre-1970', '1970-1999', 'post-2026') THEN quadrimester "
    "WHEN regexp_matches(quadrimester, '^[0-9]{4}-T[1-3]$') THEN substr(quadrimester, 1, 4) ELSE 'other' END"
)
DEDUP = f"""dated AS (SELECT *, {TS} AS ts FROM stage),
dedup AS (
  SELECT source_id, time_stamp, key, message_id, strftime(ts, '%Y') AS year, quadrimester,
    strftime(ts, '%m') AS month
  FROM dated WHERE reporting_entity = '{ENTITY}' AND quadrimester IN ({YEAR_QUADS})
    AND quadrimester = {quad('ts')}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY quadrimester, month(ts), source_id
    ORDER BY time_stamp DESC NULLS LAST, key DESC NULLS LAST, message_id DESC NULLS LAST) = 1)"""
LABELS_OF_YEARS = [f"{y}-T{n}" for y in YEARS for n in (1, 2, 3)]


def _stamp(column: str, alias: str | None = None):
    return fn.window_text(F.col(column)).alias(alias or column)


def _micros(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


# --- sources -----------------------------------------------------------------


@query("src_key_list", ("key_list",), "SELECT key FROM key_list")
def src_key_list(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "key-list")
    f.key_list.write.option("header", True).option("quoteAll", True).csv(path)
    return sources.read_key_list(f.spark, path).select("key")


@query("src_id_list", ("id_list",), "SELECT source_id FROM id_list")
def src_id_list(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "id-list")
    f.id_list.write.option("header", True).csv(path)
    return sources.read_id_list(f.spark, path).select("source_id")


@query("src_stage", ("stage",), f"SELECT {STAGE_COLUMNS} FROM stage")
def src_stage(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "stage")
    f.stage.hint("rebalance", F.col("reporting_entity"), F.col("quadrimester")).write.partitionBy(
        "reporting_entity", "quadrimester"
    ).parquet(path)
    return schemas.require(sources.read_stage(f.spark, path), schemas.STAGE)


@query(
    "src_index",
    ("index_docs",),
    f"SELECT doc_id, key, {text('start_ts')} AS start_ts, md5(content) AS content_md5 FROM index_docs",
)
def src_index(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "index")
    f.index_docs.write.parquet(path)
    docs = schemas.require(sources.read_index(f.spark, path), schemas.INDEX_DOCS)
    return docs.select("doc_id", "key", _stamp("start_ts"), F.md5("content").alias("content_md5"))


def _dedup(f: Fixtures) -> DataFrame:
    return plans.dedup(f.stage, ENTITY, LABELS_OF_YEARS)


def _dedup_table(f: Fixtures) -> str:
    path = scratch_path(f.spark, "dedup")
    table = "dedup_" + path.rsplit("-", 1)[1]
    sources.create_dedup_table(f.spark, table, path)
    sources.write_partitioned(_dedup(f), path)
    sources.repair_table(f.spark, table)
    return table


@query(
    "src_dedup",
    ("stage",),
    f", {DEDUP} SELECT source_id, time_stamp, key, message_id, year, quadrimester, month "
    "FROM dedup WHERE quadrimester = '2018-T2'",
)
def src_dedup(f: Fixtures) -> DataFrame:
    return sources.read_dedup(f.spark, _dedup_table(f), "2018-T2")


def _classified(f: Fixtures) -> DataFrame:
    return plans.source_multiplicity(f.id_list, f.index_docs)


CLASSIFIED = f"""{PAIRS},
hits AS (SELECT source_id, COUNT(*) AS n FROM pairs GROUP BY 1),
classified AS (
  SELECT source_id, COALESCE(n, 0) AS n,
    CASE COALESCE(n, 0) WHEN 0 THEN 'zero' WHEN 1 THEN 'unique' ELSE 'duplicate' END AS outcome
  FROM (SELECT DISTINCT source_id FROM id_list) LEFT JOIN hits USING (source_id))"""


@query(
    "src_ledger",
    ("index_docs", "id_list"),
    f", {CLASSIFIED} SELECT source_id FROM classified WHERE outcome IN ('unique', 'duplicate')",
)
def src_ledger(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "outcomes")
    sources.append_outcomes(_classified(f), path, 0)
    rows = read_outcomes(f.spark, path, SOURCE_OUTCOMES)
    return sources.done_keys(rows, "source_id", ["unique", "duplicate"])


# --- sinks -------------------------------------------------------------------


@query("sink_partitioned", ("stage",), f", {DEDUP} SELECT * FROM dedup")
def sink_partitioned(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "partitioned")
    sources.write_partitioned(_dedup(f), path)
    return f.spark.read.schema(schemas.DEDUP).parquet(path)


@query(
    "sink_flat", ("stage",), f", {DEDUP} SELECT source_id, time_stamp, key, message_id FROM dedup"
)
def sink_flat(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "flat")
    sources.write_flat(_dedup(f), path)
    return f.spark.read.schema(schemas.DEDUP).parquet(path).select(*schemas.DEDUP_COLUMNS)


@query(
    "sink_flat_verified",
    ("stage",),
    f", {DEDUP} SELECT quadrimester, COUNT(*) AS kept_rows, COUNT(*) AS published_rows, 'pass' AS status "
    "FROM dedup GROUP BY 1",
)
def sink_flat_verified(f: Fixtures) -> DataFrame:
    """Rows of every quadrimester published, and their content compared with what was to be."""
    kept, root = materialize(_dedup(f), "kept"), scratch_path(f.spark, "published")
    places = {r.quadrimester: f"{root}/{r.quadrimester}" for r in kept.select("quadrimester").distinct().collect()}
    for label, path in places.items():
        sources.write_flat(filters.by_quadrimester(kept, label), path)
    return plans.verify_published(kept, places)


@query(
    "sink_create_table",
    ("stage",),
    f", {DEDUP} SELECT year, quadrimester, month, COUNT(*) AS n FROM dedup GROUP BY ALL",
)
def sink_create_table(f: Fixtures) -> DataFrame:
    table = f.spark.table(_dedup_table(f))
    return table.groupBy(*schemas.DEDUP_PARTITIONS).agg(F.count("*").alias("n"))


@query(
    "sink_repair",
    ("stage",),
    f", {DEDUP} SELECT DISTINCT 'year=' || year || '/quadrimester=' || quadrimester || '/month=' || month"
    " AS partition FROM dedup",
)
def sink_repair(f: Fixtures) -> DataFrame:
    return f.spark.sql(f"SHOW PARTITIONS {_dedup_table(f)}")


@query(
    "sink_report",
    ("index_docs", "key_list"),
    """, n AS (SELECT key, COUNT(*) AS c FROM index_docs GROUP BY key)
SELECT key, COALESCE(c, 0) AS count FROM (SELECT DISTINCT key FROM key_list) LEFT JOIN n USING (key)""",
)
def sink_report(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "report")
    sources.write_report(plans.key_multiplicity(f.key_list, f.index_docs), path)
    return f.spark.read.schema("key string, count bigint").option("header", True).csv(path)


@query("sink_routed", ("index_docs", "id_list"), f", {CLASSIFIED} SELECT * FROM classified")
def sink_routed(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "routed")
    sources.write_routed(_classified(f), path)
    return f.spark.read.schema("source_id string, n bigint, outcome string").parquet(path)


def fake_sender() -> Callable[[str], tuple[int, str]]:
    """Stands in for the replay service: refuses batches of undated keys.

    A local function, so that it reaches executors by value.
    """

    def send(payload: str) -> tuple[int, str]:
        if payload.startswith("doc/"):
            return 503, BUSY
        return 200, "Keys Submitted"

    return send


# Longer than any report would like: it must come through whole.
BUSY = "queue full" + " and nothing can be taken now" * 12
BUSY_SQL = "'HTTP 503: queue full' || repeat(' and nothing can be taken now', 12)"

BATCH_N = 50
PART_N = 400  # small enough that a month is split over tasks on the test data

BATCHES = f"""listed AS (SELECT DISTINCT key FROM key_list),
tagged AS (SELECT key, {KEY_MONTH} AS key_month FROM listed
  WHERE key NOT IN (SELECT key FROM index_docs WHERE key IS NOT NULL)),
batches AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY key_month ORDER BY key) - 1) // {BATCH_N}
  AS batch_no FROM tagged),
named AS (SELECT *, key_month || '/' || batch_no AS batch FROM batches)"""


def _missing_batches(f: Fixtures) -> DataFrame:
    missing = materialize(joins.missing_keys(f.key_list, f.index_docs), "missing")
    return windows.make_batches(missing, BATCH_N, PART_N)


def _delivered(f: Fixtures) -> DataFrame:
    return plans.deliver(windows.batch_payloads(_missing_batches(f)), fake_sender(), 8)


RUNS = "runs AS (SELECT * FROM (VALUES ('batch', 1), ('batch', 2), ('stream-a', 1)) AS r(feed, run))"


def _three_runs(f: Fixtures) -> DataFrame:
    """The same deliveries stored by two calls and a stream, which reuse batch names."""
    path, rows = scratch_path(f.spark, "runs"), materialize(_delivered(f), "delivered")
    for feed, run in (("batch", 1), ("batch", 2), ("stream-a", 1)):
        sources.append_outcomes(rows, path, run, feed)
    return read_outcomes(f.spark, path, REPLAY_OUTCOMES)


@query(
    "sink_failed",
    ("index_docs", "key_list"),
    f""", {BATCHES}, {RUNS}
SELECT feed, run, 'SUBMIT' AS stage, batch, COUNT(*) AS batch_size,
  {BUSY_SQL} AS error_message, string_agg(key, ';' ORDER BY key) AS keys
FROM named, runs WHERE key_month = 'all' GROUP BY feed, run, batch HAVING MIN(key) LIKE 'doc/%'""",
)
def sink_failed(f: Fixtures) -> DataFrame:
    return sources.failed_batches(_three_runs(f))


@query(
    "sink_mismatch",
    ("stage",),
    f""", {DEDUP},
t AS (SELECT quadrimester, COUNT(*) AS temp_total_rows, COUNT(DISTINCT source_id) AS temp_distinct_sources
  FROM dedup GROUP BY 1),
s AS (SELECT quadrimester, COUNT(DISTINCT source_id) AS stage2_distinct_sources FROM stage
  WHERE reporting_entity = '{ENTITY}' AND quadrimester IN ({YEAR_QUADS}) GROUP BY 1)
SELECT quadrimester, '{ENTITY}' AS reporting_entity, COALESCE(temp_distinct_sources, 0) AS temp_distinct_sources,
  COALESCE(temp_total_rows, 0) AS temp_total_rows, COALESCE(stage2_distinct_sources, 0) AS stage2_distinct_sources,
  COALESCE(temp_distinct_sources, 0) - COALESCE(stage2_distinct_sources, 0) AS delta
FROM t FULL JOIN s USING (quadrimester)
WHERE COALESCE(temp_distinct_sources, 0) <> COALESCE(stage2_distinct_sources, 0)""",
)
def sink_mismatch(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "mismatch")
    report = plans.mismatch_report(
        plans.verify(_dedup(f), f.stage, ENTITY, LABELS_OF_YEARS), ENTITY
    ).drop("timestamp")
    sources.write_report(report, path)
    return f.spark.read.schema(report.schema).option("header", True).csv(path)


@query("sink_ledger", ("stage",), "SELECT DISTINCT quadrimester AS unit FROM stage")
def sink_ledger(f: Fixtures) -> DataFrame:
    root = scratch_path(f.spark, "ledger")
    units = f.stage.select(F.col("quadrimester").alias("unit")).distinct()
    params = sources.params_hash(entity=ENTITY)
    sources.mark_done(units, root, "check", params)
    return sources.read_ledger(f.spark, root, "check", params)


@query(
    "sink_replay",
    ("index_docs", "key_list"),
    f""", {BATCHES}, bad AS (SELECT batch FROM named GROUP BY batch HAVING MIN(key) LIKE 'doc/%')
SELECT key, batch, CASE WHEN b.batch IS NULL THEN NULL ELSE 'SUBMIT' END AS stage,
  CASE WHEN b.batch IS NULL THEN NULL ELSE {BUSY_SQL} END AS error,
  CASE WHEN b.batch IS NULL THEN 'submitted' ELSE 'failed' END AS outcome
FROM named LEFT JOIN bad b USING (batch)""",
)
def sink_replay(f: Fixtures) -> DataFrame:
    return _delivered(f)


@query(
    "sink_summary",
    ("index_docs", "id_list"),
    f", {CLASSIFIED} SELECT outcome, COUNT(*) AS n FROM classified GROUP BY outcome",
)
def sink_summary(f: Fixtures) -> DataFrame:
    return sources.run_summary(_classified(f))


@query(
    "sink_summary_batches",
    ("index_docs", "key_list"),
    f""", {BATCHES}, bad AS (SELECT batch FROM named GROUP BY batch HAVING MIN(key) LIKE 'doc/%')
SELECT CASE WHEN b.batch IS NULL THEN 'submitted' ELSE 'failed' END AS outcome, 3 * COUNT(*) AS n,
  3 * COUNT(DISTINCT named.batch) AS batches
FROM named LEFT JOIN bad b ON named.batch = b.batch GROUP BY 1""",
)
def sink_summary_batches(f: Fixtures) -> DataFrame:
    return sources.run_summary(_three_runs(f))


# --- filters -----------------------------------------------------------------


@query(
    "flt_entity", ("stage",), f"SELECT {STAGE_COLUMNS} FROM stage WHERE reporting_entity = '{ENTITY}'"
)
def flt_entity(f: Fixtures) -> DataFrame:
    return filters.by_entity(f.stage, ENTITY)


@query("flt_quad_eq", ("stage",), f"SELECT {STAGE_COLUMNS} FROM stage WHERE quadrimester = '2018-T2'")
def flt_quad_eq(f: Fixtures) -> DataFrame:
    return filters.by_quadrimester(f.stage, "2018-T2")


@query(
    "flt_quad_in",
    ("stage",),
    f"SELECT {STAGE_COLUMNS} FROM stage WHERE quadrimester IN ('1970-1999', '2018-T1', '2018-T2', '2018-T3')",
)
def flt_quad_in(f: Fixtures) -> DataFrame:
    groups = fn.year_bucket_values(["2018", "1970-1999"])
    return filters.by_quadrimesters(f.stage, [q for values in groups.values() for q in values])


@query(
    "flt_window",
    ("stage",),
    f"SELECT {STAGE_COLUMNS} FROM stage WHERE {TS} >= TIMESTAMP '2018-05-01' AND {TS} < TIMESTAMP '2018-06-01'",
)
def flt_window(f: Fixtures) -> DataFrame:
    ts = fn.epoch_ts(F.col("start_time"))
    return filters.in_window(f.stage, ts, "2018-05-01", "2018-06-01")


@query(
    "flt_window_ms",
    ("index_docs",),
    f"SELECT doc_id, key, {text('start_ts')} AS start_ts FROM index_docs WHERE start_ts >= TIMESTAMP '2018-01-01' "
    "AND start_ts <= TIMESTAMP '2018-12-31 23:59:59.999'",
)
def flt_window_ms(f: Fixtures) -> DataFrame:
    docs = filters.in_window_ms(f.index_docs, "2018-01-01", "2019-01-01")
    return docs.select("doc_id", "key", _stamp("start_ts"))


@query(
    "flt_start_range",
    ("index_docs",),
    f"SELECT doc_id, {micros('start_ts')} AS start_ts FROM index_docs WHERE start_ts >= "
    "TIMESTAMP '2016-06-01' AND start_ts < TIMESTAMP '2018-01-01'",
)
def flt_start_range(f: Fixtures) -> DataFrame:
    # Mails lie half a millisecond before full seconds: one is in the last one of 2017.
    docs = filters.in_start_range(f.index_docs, "2016-06-01", "2018-01-01")
    return docs.select("doc_id", _micros("start_ts"))


@query(
    "flt_archived_range",
    ("index_docs",),
    f"SELECT doc_id, {micros('archived_ts')} AS archived_ts FROM index_docs WHERE archived_ts >= "
    "TIMESTAMP '2023-06-01' AND archived_ts < TIMESTAMP '2027-01-01'",
)
def flt_archived_range(f: Fixtures) -> DataFrame:
    docs = filters.in_archived_range(f.index_docs, "2023-06-01", "2027-01-01")
    return docs.select("doc_id", _micros("archived_ts"))


@query(
    "flt_terms",
    ("index_docs", "key_list"),
    "SELECT doc_id, key FROM index_docs WHERE key IN (SELECT key FROM key_list)",
)
def flt_terms(f: Fixtures) -> DataFrame:
    return filters.with_listed_keys(f.index_docs, f.key_list).select("doc_id", "key")


@query(
    "flt_entity_phrase",
    ("index_docs",),
    f"SELECT doc_id, key FROM index_docs WHERE list_contains({ENT_VALUES}, '{ENTITY}')",
)
def flt_entity_phrase(f: Fixtures) -> DataFrame:
    return filters.with_entity_phrase(f.index_docs, ENTITY).select("doc_id", "key")


@query(
    "flt_source_phrase",
    ("index_docs",),
    f"SELECT doc_id, key FROM index_docs WHERE list_contains({SRC_VALUES}, 'MAIL-12')",
)
def flt_source_phrase(f: Fixtures) -> DataFrame:
    return filters.with_source_phrase(f.index_docs, "MAIL-12").select("doc_id", "key")


@query(
    "flt_latest",
    ("stage",),
    f""" SELECT {STAGE_COLUMNS} FROM stage QUALIFY ROW_NUMBER() OVER (PARTITION BY quadrimester, source_id
  ORDER BY time_stamp DESC NULLS LAST, key DESC NULLS LAST, message_id DESC NULLS LAST, start_time DESC NULLS LAST,
  reporting_entity DESC NULLS LAST) = 1""",
)
def flt_latest(f: Fixtures) -> DataFrame:
    order = (*windows.LATEST, "start_time", "reporting_entity")
    return filters.latest_only(windows.rank_latest(f.stage, ["quadrimester", "source_id"], order))


@query(
    "flt_duplicates",
    ("index_docs",),
    "SELECT key, COUNT(*) AS n FROM index_docs WHERE key IS NOT NULL GROUP BY key HAVING COUNT(*) > 1",
)
def flt_duplicates(f: Fixtures) -> DataFrame:
    return filters.duplicates(aggregates.count_by_key(f.index_docs))


def _day_histograms(f: Fixtures) -> DataFrame:
    lake = (
        aggregates.distinct_by_unit(f.stage, "day")
        .groupBy("bucket")
        .agg(F.sum("key_count").alias("n"))
    )
    return joins.align_histograms(aggregates.histogram(f.index_docs, "day"), lake)


DAY_HISTOGRAMS = f"""l AS (SELECT date_trunc('day', start_ts) AS b, COUNT(*) AS left_n FROM index_docs GROUP BY 1),
r AS (SELECT b, SUM(n) AS right_n FROM (
  SELECT quadrimester, date_trunc('day', {TS}) AS b, COUNT(DISTINCT key) AS n FROM stage
  WHERE {TS} IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
pair AS (SELECT strftime(COALESCE(l.b, r.b), '%Y-%m-%d') AS bucket, COALESCE(left_n, 0) AS left_n,
  CAST(COALESCE(right_n, 0) AS BIGINT) AS right_n FROM l FULL JOIN r ON l.b = r.b)"""


@query(
    "flt_mismatch",
    ("stage", "index_docs"),
    f", {DAY_HISTOGRAMS} SELECT * FROM pair WHERE left_n <> right_n",
)
def flt_mismatch(f: Fixtures) -> DataFrame:
    return filters.mismatched(_day_histograms(f)).withColumn(
        "bucket", fn.bucket_label("day", F.col("bucket"))
    )


@query("flt_text_key", ("index_docs",), "SELECT doc_id, key FROM index_docs WHERE key IS NOT NULL")
def flt_text_key(f: Fixtures) -> DataFrame:
    return filters.with_text_key(f.index_docs).select("doc_id", "key")


RESUMED = (
    f"SELECT DISTINCT key FROM key_list WHERE key NOT IN (SELECT key FROM stage WHERE reporting_entity = '{ENTITY}') "
    "AND key NOT IN (SELECT key FROM index_docs WHERE key IS NOT NULL)"
)


def _two_runs_left(f: Fixtures, compact: bool) -> DataFrame:
    """What two recorded runs leave to do: one submitted an entity's keys and failed the undated
    ones, the other skipped what the index has. `compact`: the first is merged before the second."""
    path, nothing = scratch_path(f.spark, "two-runs"), F.lit(None).cast("string")
    entity, undated = filters.by_entity(f.stage, ENTITY), f.key_list.where(F.col("key").startswith("doc/"))
    runs = (
        [(entity.select("key"), "submitted"), (undated, "failed")],
        [(filters.with_text_key(f.index_docs).select("key"), "skipped")],
    )
    for run in runs:
        rows = [keys.distinct().withColumn("outcome", F.lit(outcome)) for keys, outcome in run]
        found = reduce(DataFrame.unionByName, rows)
        sources.append_outcomes(found.withColumns({c: nothing for c in ("batch", "stage", "error")}), path)
        if compact and run is runs[0]:
            sources.compact_outcomes(f.spark, path, REPLAY_OUTCOMES, "key")
    done = sources.done_keys(read_outcomes(f.spark, path, REPLAY_OUTCOMES), "key", REPLAY_DONE)
    return filters.not_done(f.key_list.distinct(), done, "key")


@query("flt_resume", ("stage", "index_docs", "key_list"), RESUMED)
def flt_resume(f: Fixtures) -> DataFrame:
    return _two_runs_left(f, compact=False)


@query("src_ledger_compacted", ("stage", "index_docs", "key_list"), RESUMED)
def src_ledger_compacted(f: Fixtures) -> DataFrame:
    return _two_runs_left(f, compact=True)


@query(
    "flt_quad_subset",
    ("stage",),
    f""", y AS (SELECT DISTINCT year({TS}) AS y FROM stage WHERE {TS} IS NOT NULL)
SELECT {STAGE_COLUMNS} FROM stage WHERE quadrimester IN
  (SELECT CAST(y AS STRING) || '-T' || CAST(n AS STRING) FROM y, (VALUES (1), (2), (3)) t(n))""",
)
def flt_quad_subset(f: Fixtures) -> DataFrame:
    years = f.dated_stage.where("ts IS NOT NULL").select(F.year("ts").alias("year")).distinct()
    return filters.in_years(f.stage, years).select(*schemas.STAGE.fieldNames())


# --- functions ---------------------------------------------------------------


@query("fn_epoch_ts", ("stage",), f"SELECT key, start_time, {text(TS)} AS ts FROM stage")
def fn_epoch_ts(f: Fixtures) -> DataFrame:
    return f.stage.select(
        "key", "start_time", fn.window_text(fn.epoch_ts(F.col("start_time"))).alias("ts")
    )


@query("fn_year", ("stage",), f"SELECT key, CAST(year({TS}) AS INT) AS year FROM stage")
def fn_year(f: Fixtures) -> DataFrame:
    return f.dated_stage.select("key", fn.year_of(F.col("ts")).alias("year"))


@query("fn_year_month", ("stage",), f"SELECT key, strftime({TS}, '%Y-%m') AS year_month FROM stage")
def fn_year_month(f: Fixtures) -> DataFrame:
    return f.dated_stage.select("key", fn.year_month(F.col("ts")).alias("year_month"))


@query(
    "fn_time_unit",
    ("stage",),
    "SELECT key, "
    + ", ".join(f"CAST({u}({TS}) AS INT) AS {u}_no" for u in ("day", "hour", "minute", "second"))
    + " FROM stage",
)
def fn_time_unit(f: Fixtures) -> DataFrame:
    units = ("day", "hour", "minute", "second")
    return f.dated_stage.select(
        "key", *[fn.time_unit(u, F.col("ts")).alias(f"{u}_no") for u in units]
    )


@query(
    "fn_bucket_label",
    ("index_docs",),
    "SELECT doc_id, "
    + ", ".join(f"strftime(date_trunc('{lv}', start_ts), '{p}') AS {lv}_label" for lv, p in LABELS.items())
    + " FROM index_docs",
)
def fn_bucket_label(f: Fixtures) -> DataFrame:
    return f.index_docs.select(
        "doc_id", *[fn.bucket_label(lv, F.col("start_ts")).alias(f"{lv}_label") for lv in fn.LEVELS]
    )


@query(
    "fn_quad_of_date",
    (),
    "SELECT o_orderkey, CAST(year(o_orderdate) AS STRING) || '-T' || "
    "CAST(CAST(CEIL(month(o_orderdate) / 4.0) AS INT) AS STRING) AS quadrimester FROM orders",
)
def fn_quad_of_date(f: Fixtures) -> DataFrame:
    date = F.col("o_orderdate")
    return f.table("orders").select(
        "o_orderkey", fn.quadrimester_month(F.year(date), F.month(date)).alias("quadrimester")
    )


@query("fn_quad_of_key", ("index_docs",), f"SELECT doc_id, key, {KEY_QUAD} AS quadrimester FROM index_docs")
def fn_quad_of_key(f: Fixtures) -> DataFrame:
    return f.index_docs.select(
        "doc_id", "key", fn.quadrimester_of_key(F.col("key")).alias("quadrimester")
    )


@query(
    "fn_quad_parse",
    ("stage",),
    """SELECT key, quadrimester,
  CASE WHEN regexp_matches(quadrimester, '^[0-9]+-T[1-3]$') THEN CAST(split_part(quadrimester, '-T', 1) AS INT) END AS year,
  CASE WHEN regexp_matches(quadrimester, '^[0-9]+-T[1-3]$') THEN CAST(split_part(quadrimester, '-T', 2) AS INT) END AS n
FROM stage""",
)
def fn_quad_parse(f: Fixtures) -> DataFrame:
    parsed = fn.parse_quadrimester(F.col("quadrimester"))
    return f.stage.select(
        "key", "quadrimester", parsed["year"].alias("year"), parsed["n"].alias("n")
    )


@query("fn_key_month", ("key_list",), f"SELECT key, {KEY_MONTH} AS key_month FROM key_list")
def fn_key_month(f: Fixtures) -> DataFrame:
    return f.key_list.select("key", fn.key_month(F.col("key")).alias("key_month"))


def _windows_sql() -> str:
    parts = []
    for lv in LABELS:
        start = f"date_trunc('{lv}', start_ts)"
        parts += [
            f"{text(start)} AS {lv}_start",
            text(f"({start} + INTERVAL 1 {lv})") + f" AS {lv}_end",
        ]
    return f"SELECT doc_id, {', '.join(parts)} FROM index_docs"


@query("fn_window_of_unit", ("index_docs",), _windows_sql())
def fn_window_of_unit(f: Fixtures) -> DataFrame:
    columns = []
    for level in fn.LEVELS:
        start, end = fn.window_of(level, F.col("start_ts"))
        columns += [
            fn.window_text(start).alias(f"{level}_start"),
            fn.window_text(end).alias(f"{level}_end"),
        ]
    return f.index_docs.select("doc_id", *columns)


@query(
    "fn_window_text", ("index_docs",), f"SELECT doc_id, {text('archived_ts')} AS archived FROM index_docs"
)
def fn_window_text(f: Fixtures) -> DataFrame:
    return f.index_docs.select("doc_id", _stamp("archived_ts", "archived"))


@query(
    "fn_months_of_quad",
    ("stage",),
    """, q AS (SELECT DISTINCT quadrimester, CAST(substr(quadrimester, 1, 4) AS INT) AS y,
  CAST(substr(quadrimester, 7, 1) AS INT) AS n FROM stage WHERE regexp_matches(quadrimester, '^[0-9]+-T[1-3]$')),
m AS (SELECT quadrimester, make_date(y, (n - 1) * 4 + 1 + k, 1) AS d FROM q, (VALUES (0), (1), (2), (3)) t(k))
SELECT quadrimester, strftime(d, '%m') AS month, strftime(d, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(d + INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S') AS window_end_exclusive FROM m""",
)
def fn_months_of_quad(f: Fixtures) -> DataFrame:
    parsed = fn.parse_quadrimester(F.col("quadrimester"))
    months = (
        f.stage.select("quadrimester", parsed.alias("q"))
        .where("q IS NOT NULL")
        .distinct()
        .select("quadrimester", F.explode(fn.months_of_quadrimester(F.col("q.year"), F.col("q.n"))).alias("d"))
    )
    start, end = fn.window_of("month", F.col("d"))
    return months.select(
        "quadrimester",
        F.date_format("d", "MM").alias("month"),
        fn.window_text(start).alias("window_start"),
        fn.window_text(end).alias("window_end_exclusive"),
    )


@query(
    "fn_expand_years",
    ("stage",),
    f""", y AS (SELECT DISTINCT year({TS}) AS y FROM stage WHERE {TS} IS NOT NULL)
SELECT CAST(y AS INT) AS year, CAST(y AS STRING) || '-T' || CAST(n AS STRING) AS quadrimester
FROM y, (VALUES (1), (2), (3)) t(n)""",
)
def fn_expand_years(f: Fixtures) -> DataFrame:
    years = f.dated_stage.where("ts IS NOT NULL").select(F.year("ts").alias("year")).distinct()
    return years.select("year", F.explode(fn.expand_years(F.col("year"))).alias("quadrimester"))


@query("fn_year_bucket", ("stage",), f"SELECT key, quadrimester, {BUCKET} AS bucket FROM stage")
def fn_year_bucket(f: Fixtures) -> DataFrame:
    return f.stage.select(
        "key", "quadrimester", fn.year_bucket_label(F.col("quadrimester")).alias("bucket")
    )


@query(
    "fn_first_column",
    ("key_list",),
    """SELECT key, key AS quoted, key AS plain, ',' || key AS lead, '"' || key AS unclosed, '' AS nothing
FROM key_list""",
)
def fn_first_column(f: Fixtures) -> DataFrame:
    key = F.col("key")
    return f.key_list.select(
        "key",
        fn.first_column(F.concat(F.lit('"'), key, F.lit('","b",c'))).alias("quoted"),
        fn.first_column(F.concat(key, F.lit(',"x",y'))).alias("plain"),
        fn.first_column(F.concat(F.lit(","), key)).alias("lead"),
        fn.first_column(F.concat(F.lit('"'), key)).alias("unclosed"),
        fn.first_column(F.concat(F.lit('""'), key)).alias("nothing"),
    )


@query(
    "fn_literal_tags",
    ("stage",),
    f"SELECT source_id, key, strftime({TS}, '%Y') AS year, {quad(TS)} AS quadrimester, "
    f"strftime({TS}, '%m') AS month FROM stage",
)
def fn_literal_tags(f: Fixtures) -> DataFrame:
    return f.dated_stage.select(
        "source_id",
        "key",
        *fn.literal_tags(F.col("ts")),
    )


@query(
    "fn_sanitize_entity",
    ("stage",),
    "SELECT reporting_entity, replace(reporting_entity, '.', '_') AS name, COUNT(*) AS n FROM stage GROUP BY ALL",
)
def fn_sanitize_entity(f: Fixtures) -> DataFrame:
    entity = F.col("reporting_entity")
    return f.stage.groupBy(entity, fn.sanitize_entity(entity).alias("name")).agg(
        F.count("*").alias("n")
    )


@query(
    "fn_safe_error",
    (),
    "SELECT doc_id, md5(replace(replace(text, '\"', ''''), chr(10), ' ')) AS error_md5 FROM documents",
)
def fn_safe_error(f: Fixtures) -> DataFrame:
    return f.table("documents").select(
        "doc_id", F.md5(fn.safe_error(F.col("text"))).alias("error_md5")
    )


@query("fn_classify", ("index_docs", "id_list"), f", {CLASSIFIED} SELECT source_id, n, outcome FROM classified")
def fn_classify(f: Fixtures) -> DataFrame:
    return _classified(f)


@query(
    "fn_extract_marker",
    ("index_docs",),
    f"SELECT doc_id, UNNEST({SRC_VALUES}) AS source_id FROM index_docs",
)
def fn_extract_marker(f: Fixtures) -> DataFrame:
    return f.index_docs.select(
        "doc_id", F.explode(fn.extract_marker(F.col("content"))).alias("source_id")
    )


@query("proj_key_only", ("index_docs",), "SELECT key FROM index_docs")
def proj_key_only(f: Fixtures) -> DataFrame:
    return f.index_docs.select("key")


# --- joins -------------------------------------------------------------------

MISSING_SQL = "SELECT DISTINCT key FROM key_list WHERE key {op} (SELECT key FROM index_docs WHERE key IS NOT NULL)"


@query("join_missing", ("index_docs", "key_list"), MISSING_SQL.format(op="NOT IN"))
def join_missing(f: Fixtures) -> DataFrame:
    return joins.missing_keys(f.key_list, f.index_docs)


@query("join_present", ("index_docs", "key_list"), MISSING_SQL.format(op="IN"))
def join_present(f: Fixtures) -> DataFrame:
    return joins.present_keys(f.key_list, f.index_docs)


@query(
    "join_count_default0",
    ("index_docs", "key_list"),
    """, n AS (SELECT key, COUNT(*) AS c FROM index_docs GROUP BY key)
SELECT key, COALESCE(c, 0) AS count FROM (SELECT DISTINCT key FROM key_list) LEFT JOIN n USING (key)""",
)
def join_count_default0(f: Fixtures) -> DataFrame:
    # A bound of 0 takes the way meant for lists too long to broadcast.
    return joins.count_default_zero(f.key_list, f.index_docs, max_rows=0)


QUADRIMESTER_LIST = "(SELECT key FROM stage WHERE quadrimester = '2018-T2')"


@query(
    "join_missing_reduced",
    ("stage", "index_docs"),
    f"SELECT DISTINCT key FROM {QUADRIMESTER_LIST} WHERE key NOT IN (SELECT key FROM index_docs WHERE key IS NOT NULL)",
)
def join_missing_reduced(f: Fixtures) -> DataFrame:
    """A list too long to broadcast, far shorter than the index."""
    return joins.missing_keys(filters.by_quadrimester(f.stage, "2018-T2").select("key"), f.index_docs, max_rows=0)


@query(
    "join_count_reduced",
    ("stage", "index_docs"),
    f""", n AS (SELECT key, COUNT(*) AS c FROM index_docs GROUP BY key)
SELECT key, COALESCE(c, 0) AS count FROM (SELECT DISTINCT key FROM {QUADRIMESTER_LIST}) LEFT JOIN n USING (key)""",
)
def join_count_reduced(f: Fixtures) -> DataFrame:
    return joins.count_default_zero(filters.by_quadrimester(f.stage, "2018-T2").select("key"), f.index_docs, max_rows=0)


@query(
    "flt_terms_reduced",
    ("stage", "index_docs"),
    f"SELECT doc_id, key FROM index_docs WHERE key IN {QUADRIMESTER_LIST}",
)
def flt_terms_reduced(f: Fixtures) -> DataFrame:
    keys = filters.by_quadrimester(f.stage, "2018-T2").select("key")
    return filters.with_listed_keys(f.index_docs, keys, max_rows=0).select("doc_id", "key")


@query(
    "join_phrase",
    ("index_docs", "id_list"),
    f", {PAIRS} SELECT source_id, doc_id, key FROM pairs WHERE source_id IN (SELECT source_id FROM id_list)",
)
def join_phrase(f: Fixtures) -> DataFrame:
    return joins.phrase_pairs(f.id_list, f.index_docs).select("source_id", "doc_id", "key")


@query(
    "join_lookup",
    ("stage", "index_docs"),
    f""", {PAIRS}, q AS (SELECT DISTINCT source_id, {KEY_QUAD} AS quadrimester FROM pairs WHERE key IS NOT NULL),
c AS (SELECT source_id, quadrimester, COUNT(*) AS n FROM stage WHERE reporting_entity = '{ENTITY}' GROUP BY 1, 2)
SELECT q.source_id, q.quadrimester, COALESCE(n, 0) AS lake_count
FROM q LEFT JOIN c ON q.source_id = c.source_id AND q.quadrimester = c.quadrimester""",
)
def join_lookup(f: Fixtures) -> DataFrame:
    pairs = joins.source_pairs(filters.with_text_key(f.index_docs))
    id_keys = pairs.select(
        "source_id", fn.quadrimester_of_key(F.col("key")).alias("quadrimester")
    ).distinct()
    return joins.lake_counts(materialize(id_keys, "id-keys"), f.stage, ENTITY, max_rows=0)


@query("join_histograms", ("stage", "index_docs"), f", {DAY_HISTOGRAMS} SELECT * FROM pair")
def join_histograms(f: Fixtures) -> DataFrame:
    return _day_histograms(f).withColumn("bucket", fn.bucket_label("day", F.col("bucket")))


@query(
    "join_key_diff",
    ("stage", "index_docs"),
    f""", l AS (SELECT DISTINCT strftime(start_ts, '%Y-%m-%d') AS bucket, key FROM index_docs WHERE key IS NOT NULL),
r AS (SELECT DISTINCT strftime({TS}, '%Y-%m-%d') AS bucket, key FROM stage WHERE {TS} IS NOT NULL)
SELECT bucket, key, 'ES_ONLY' AS source FROM (SELECT * FROM l EXCEPT SELECT * FROM r)
UNION ALL SELECT bucket, key, 'ATHENA_ONLY' FROM (SELECT * FROM r EXCEPT SELECT * FROM l)""",
)
def join_key_diff(f: Fixtures) -> DataFrame:
    left = f.index_docs.select(fn.bucket_label("day", F.col("start_ts")).alias("bucket"), "key")
    right = f.dated_stage.where("ts IS NOT NULL").select(
        fn.bucket_label("day", F.col("ts")).alias("bucket"), "key"
    )
    return joins.one_sided_keys(left, right, ["bucket", "key"], "ES_ONLY", "ATHENA_ONLY")


@query(
    "join_drill",
    ("stage", "index_docs"),
    f""", {DAY_HISTOGRAMS}
SELECT doc_id, {text('start_ts')} AS start_ts FROM index_docs
WHERE strftime(start_ts, '%Y-%m-%d') IN (SELECT bucket FROM pair WHERE left_n <> right_n)""",
)
def join_drill(f: Fixtures) -> DataFrame:
    frontier = filters.mismatched(_day_histograms(f))
    return joins.under_frontier(f.index_docs, F.col("start_ts"), frontier, "day").select(
        "doc_id", _stamp("start_ts")
    )


# --- aggregates --------------------------------------------------------------


@query(
    "agg_distinct_by_year",
    ("stage",),
    f"SELECT CAST(year({TS}) AS INT) AS year, COUNT(DISTINCT key) AS key_count FROM stage GROUP BY 1",
)
def agg_distinct_by_year(f: Fixtures) -> DataFrame:
    return aggregates.distinct_by_year(f.stage)


@query(
    "agg_distinct_by_year_field",
    ("stage",),
    f"SELECT CAST(year({TS}) AS INT) AS year, COUNT(DISTINCT source_id) AS source_id_count FROM stage GROUP BY 1",
)
def agg_distinct_by_year_field(f: Fixtures) -> DataFrame:
    return aggregates.distinct_by_year(f.stage, "source_id")


@query(
    "agg_distinct_by_month",
    ("stage",),
    f"SELECT strftime({TS}, '%Y-%m') AS year_month, COUNT(DISTINCT key) AS key_count FROM stage GROUP BY 1",
)
def agg_distinct_by_month(f: Fixtures) -> DataFrame:
    return aggregates.distinct_by_month(f.stage)


def _register_units() -> None:
    for unit in ("day", "hour", "minute", "second"):

        @query(
            f"agg_distinct_by_unit_{unit}",
            ("stage",),
            f"""SELECT quadrimester, strftime(date_trunc('{unit}', {TS}), '{LABELS[unit]}') AS bucket,
  COUNT(DISTINCT key) AS key_count, CAST({unit}(date_trunc('{unit}', {TS})) AS INT) AS unit
FROM stage WHERE {TS} IS NOT NULL GROUP BY quadrimester, date_trunc('{unit}', {TS})""",
        )
        def by_unit(f: Fixtures, unit: str = unit) -> DataFrame:
            return aggregates.distinct_by_unit(f.stage, unit).withColumn(
                "bucket", fn.bucket_label(unit, F.col("bucket"))
            )


_register_units()


def _register_histograms() -> None:
    for level in fn.LEVELS:

        @query(
            "agg_histogram" if level == "month" else f"agg_histogram_{level}",
            ("index_docs",),
            f"SELECT strftime(start_ts, '{LABELS[level]}') AS bucket, COUNT(*) AS n FROM index_docs "
            "WHERE start_ts IS NOT NULL GROUP BY 1",
        )
        def by_level(f: Fixtures, level: str = level) -> DataFrame:
            return aggregates.histogram(f.index_docs, level).withColumn(
                "bucket", fn.bucket_label(level, F.col("bucket"))
            )


_register_histograms()


@query(
    "agg_count_filtered",
    ("index_docs",),
    f"SELECT COUNT(*) AS n FROM index_docs WHERE list_contains({ENT_VALUES}, '{ENTITY}')",
)
def agg_count_filtered(f: Fixtures) -> DataFrame:
    values = fn.extract_marker(F.col("content"), fn.ENTITY_MARKER)
    return aggregates.count_filtered(f.index_docs, F.array_contains(values, ENTITY))


@query(
    "agg_count_by_key",
    ("index_docs",),
    "SELECT key, COUNT(*) AS n FROM index_docs WHERE key IS NOT NULL GROUP BY key",
)
def agg_count_by_key(f: Fixtures) -> DataFrame:
    return aggregates.count_by_key(f.index_docs)


@query(
    "agg_count_by_source",
    ("index_docs",),
    f", {PAIRS} SELECT source_id, COUNT(*) AS n FROM pairs GROUP BY source_id",
)
def agg_count_by_source(f: Fixtures) -> DataFrame:
    return aggregates.count_by_source(joins.source_pairs(f.index_docs))


@query(
    "agg_stage_rows",
    ("stage",),
    "SELECT reporting_entity, quadrimester, source_id, COUNT(*) AS n FROM stage GROUP BY 1, 2, 3",
)
def agg_stage_rows(f: Fixtures) -> DataFrame:
    return aggregates.stage_rows(f.stage)


@query(
    "agg_verify",
    ("stage",),
    "SELECT quadrimester, COUNT(*) AS total_rows, COUNT(DISTINCT source_id) AS distinct_sources FROM stage GROUP BY 1",
)
def agg_verify(f: Fixtures) -> DataFrame:
    return aggregates.verify_counts(f.stage)


@query(
    "agg_dup_summary",
    ("index_docs", "key_list"),
    """, n AS (SELECT key, COUNT(*) AS c FROM index_docs GROUP BY key)
SELECT COUNT(*) AS keys_counted, COUNT(*) FILTER (WHERE c > 1) AS duplicate_keys
FROM (SELECT DISTINCT key FROM key_list) LEFT JOIN n USING (key)""",
)
def agg_dup_summary(f: Fixtures) -> DataFrame:
    return aggregates.duplicate_summary(plans.key_multiplicity(f.key_list, f.index_docs))


# --- windows, order, limits, sets --------------------------------------------


@query(
    "win_latest",
    ("stage",),
    f""", r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY quadrimester, source_id ORDER BY time_stamp DESC NULLS LAST,
  key DESC NULLS LAST, message_id DESC NULLS LAST, start_time DESC NULLS LAST, reporting_entity DESC NULLS LAST) AS rn
  FROM stage)
SELECT {STAGE_COLUMNS}, CAST(rn AS INT) AS rn FROM r WHERE rn <= 2""",
)
def win_latest(f: Fixtures) -> DataFrame:
    order = (*windows.LATEST, "start_time", "reporting_entity")
    return windows.rank_latest(f.stage, ["quadrimester", "source_id"], order, keep=2)


@query(
    "win_batch", ("index_docs", "key_list"), f", {BATCHES} SELECT key, key_month, batch_no FROM batches"
)
def win_batch(f: Fixtures) -> DataFrame:
    return _missing_batches(f).select("key", "key_month", "batch_no")


@query(
    "sort_year",
    ("stage",),
    f"SELECT CAST(year({TS}) AS INT) AS year, COUNT(DISTINCT key) AS key_count FROM stage GROUP BY 1 ORDER BY 1 NULLS LAST",
)
def sort_year(f: Fixtures) -> DataFrame:
    return ordering.sort_buckets(aggregates.distinct_by_year(f.stage), "year")


@query(
    "sort_bucket",
    ("stage",),
    f"SELECT strftime({TS}, '%Y-%m') AS year_month, COUNT(DISTINCT key) AS key_count FROM stage "
    "GROUP BY 1 ORDER BY 1 NULLS LAST",
)
def sort_bucket(f: Fixtures) -> DataFrame:
    return ordering.sort_buckets(aggregates.distinct_by_month(f.stage), "year_month")


@query(
    "sort_doc_time",
    ("index_docs",),
    f"SELECT doc_id, key, {text('start_ts')} AS start_ts FROM index_docs ORDER BY index_docs.start_ts, doc_id",
)
def sort_doc_time(f: Fixtures) -> DataFrame:
    docs = f.index_docs.select("doc_id", "key", "start_ts")
    return ordering.sort_documents(docs).withColumn("start_ts", fn.window_text(F.col("start_ts")))


@query(
    "limit_input",
    ("index_docs", "key_list"),
    "SELECT DISTINCT key FROM key_list WHERE key NOT IN "
    "(SELECT key FROM index_docs WHERE key IS NOT NULL) ORDER BY key LIMIT 100",
)
def limit_input(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "limited-list")
    # Stored, as ordering by ranges reads its input twice.
    materialize(f.key_list, "unordered-list").orderBy("key").write.option("header", True).csv(path)
    listed = sources.read_key_list(f.spark, path)
    return ordering.limit_inputs(listed, f.index_docs, "key", 100)


@query(
    "limit_per_id",
    ("index_docs",),
    f""", {PAIRS} SELECT source_id, key, doc_id FROM pairs
QUALIFY ROW_NUMBER() OVER (PARTITION BY source_id ORDER BY key NULLS LAST, doc_id) <= 2""",
)
def limit_per_id(f: Fixtures) -> DataFrame:
    return windows.limit_per_id(joins.source_pairs(f.index_docs), 2).select(
        "source_id", "key", "doc_id"
    )


@query("set_distinct_keys", ("stage",), "SELECT DISTINCT key FROM stage")
def set_distinct_keys(f: Fixtures) -> DataFrame:
    return sets.distinct_keys(f.stage)


@query(
    "set_index_only",
    ("stage", "index_docs"),
    "SELECT DISTINCT key FROM index_docs WHERE key IS NOT NULL AND key NOT IN (SELECT key FROM stage)",
)
def set_index_only(f: Fixtures) -> DataFrame:
    return sets.index_only(f.index_docs, f.stage)


@query(
    "set_lake_only",
    ("stage", "index_docs"),
    "SELECT DISTINCT key FROM stage WHERE key NOT IN (SELECT key FROM index_docs WHERE key IS NOT NULL)",
)
def set_lake_only(f: Fixtures) -> DataFrame:
    return sets.lake_only(f.index_docs, f.stage)


@query(
    "set_bucket_union",
    ("stage", "index_docs"),
    f"SELECT strftime(start_ts, '%Y-%m-%d') AS bucket FROM index_docs UNION "
    f"SELECT strftime({TS}, '%Y-%m-%d') FROM stage WHERE {TS} IS NOT NULL",
)
def set_bucket_union(f: Fixtures) -> DataFrame:
    return sets.bucket_union(
        aggregates.histogram(f.index_docs, "day"), aggregates.distinct_by_unit(f.stage, "day")
    ).select(fn.bucket_label("day", F.col("bucket")).alias("bucket"))


@query(
    "set_ledger_union",
    ("index_docs", "id_list"),
    f", {CLASSIFIED} SELECT source_id FROM classified WHERE outcome <> 'zero'",
)
def set_ledger_union(f: Fixtures) -> DataFrame:
    rows = materialize(_classified(f), "classified")
    parts = [rows.where(F.col("outcome") == o).select("source_id") for o in ("unique", "duplicate")]
    return sources.ledger_union(*parts)


# --- plans -------------------------------------------------------------------


REPLAY_SQL = f""", {BATCHES}, bad AS (SELECT batch FROM named GROUP BY batch HAVING MIN(key) LIKE 'doc/%')
SELECT key, 'skipped' AS outcome, CAST(NULL AS VARCHAR) AS stage, CAST(NULL AS VARCHAR) AS batch,
  CAST(NULL AS VARCHAR) AS error FROM listed WHERE key IN (SELECT key FROM index_docs WHERE key IS NOT NULL)
UNION ALL
SELECT key, CASE WHEN b.batch IS NULL THEN 'submitted' ELSE 'failed' END,
  CASE WHEN b.batch IS NULL THEN NULL ELSE 'SUBMIT' END, named.batch,
  CASE WHEN b.batch IS NULL THEN NULL ELSE {BUSY_SQL} END
FROM named LEFT JOIN bad b ON named.batch = b.batch"""
REPLAY_COLUMNS = ("key", "outcome", "stage", "batch", "error")


@query(
    "pipe_replay",
    ("index_docs", "key_list"),
    REPLAY_SQL.replace(f"// {BATCH_N}", "// 500").replace(f"/ {PART_N}.0", "/ 1000000.0"),
)
def pipe_replay(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "replay")
    done = plans.replay(f.key_list, f.index_docs, path, fake_sender())
    return done.select(*REPLAY_COLUMNS)


@query(
    "stream_resume",
    ("index_docs", "key_list"),
    REPLAY_SQL.replace(f"// {BATCH_N}", "// 500").replace(f"/ {PART_N}.0", "/ 1000000.0"),
)
def stream_resume(f: Fixtures) -> DataFrame:
    lists, path = scratch_path(f.spark, "stream-in"), scratch_path(f.spark, "stream-out")
    f.key_list.write.option("header", True).csv(lists)
    run = replay_new_files(
        f.spark, lists, f.index_docs, path, scratch_path(f.spark, "stream-state"), fake_sender()
    )
    run.awaitTermination()
    return read_outcomes(f.spark, path, REPLAY_OUTCOMES).select(*REPLAY_COLUMNS)


@query(
    "pipe_source_multiplicity",
    ("index_docs", "id_list"),
    f", {CLASSIFIED} SELECT source_id, n, outcome FROM classified",
)
def pipe_source_multiplicity(f: Fixtures) -> DataFrame:
    return plans.source_multiplicity(f.id_list, f.index_docs, max_rows=0)


def _postings(f: Fixtures) -> DataFrame:
    """The marker index over stored documents, grown in two steps."""
    docs, root = scratch_path(f.spark, "index-docs"), scratch_path(f.spark, "markers")
    half = F.xxhash64("doc_id") % 2 == 0
    for part in (half, ~half):
        f.index_docs.where(part).write.mode("append").option("compression", "zstd").parquet(docs)
        sources.grow_markers(f.spark, docs, root)
    return sources.read_markers(f.spark, root, docs)


POSTINGS_SQL = " UNION ALL ".join(
    f"SELECT '{marker}' AS marker, UNNEST({values}) AS value, doc_id, key, start_ts, archived_ts FROM index_docs"
    for marker, values in (("X-SOURCE-ID", SRC_VALUES), ("X-REPORTING-ENTITY", ENT_VALUES))
)


@query(
    "src_markers",
    ("index_docs",),
    f"SELECT marker, value, doc_id, key, {micros('start_ts')} AS start_ts, {micros('archived_ts')} AS archived_ts "
    f"FROM ({POSTINGS_SQL})",
)
def src_markers(f: Fixtures) -> DataFrame:
    return _postings(f).select("marker", "value", "doc_id", "key", _micros("start_ts"), _micros("archived_ts"))


@query(
    "pipe_source_multiplicity_indexed",
    ("index_docs", "id_list"),
    f", {CLASSIFIED} SELECT source_id, n, outcome FROM classified",
)
def pipe_source_multiplicity_indexed(f: Fixtures) -> DataFrame:
    return plans.source_multiplicity(f.id_list, _postings(f), max_rows=0)


@query(
    "pipe_key_multiplicity",
    ("index_docs", "key_list"),
    """, n AS (SELECT key, COUNT(*) AS c FROM index_docs GROUP BY key)
SELECT key, COALESCE(c, 0) AS count FROM (SELECT DISTINCT key FROM key_list) LEFT JOIN n USING (key)""",
)
def pipe_key_multiplicity(f: Fixtures) -> DataFrame:
    return plans.key_multiplicity(f.key_list, f.index_docs)


@query(
    "pipe_year_counts",
    ("stage",),
    f"""SELECT {BUCKET} AS bucket, CAST(year({TS}) AS INT) AS year, COUNT(DISTINCT key) AS key_count
FROM stage WHERE reporting_entity = '{ENTITY}' GROUP BY 1, 2""",
)
def pipe_year_counts(f: Fixtures) -> DataFrame:
    return plans.year_counts(f.stage, ENTITY)


EXACT_SQL = f"""dated AS (SELECT *, {TS} AS ts FROM stage),
l AS (SELECT date_trunc('second', start_ts) AS second, key FROM index_docs
  WHERE list_contains({ENT_VALUES}, '{ENTITY}') AND year(start_ts) BETWEEN {YEARS[0]} AND {YEARS[-1]}),
r AS (SELECT ts AS second, key, quadrimester = {quad('ts')} AS exact FROM dated
  WHERE reporting_entity = '{ENTITY}' AND quadrimester IN ({YEAR_QUADS})
    AND strftime(ts, '%Y') = substr(quadrimester, 1, 4)),
rows AS (SELECT second, key, SUM(d) AS docs, bool_or(a) AS lake_any, bool_or(e) AS lake_exact FROM (
  SELECT second, key, 1 AS d, false AS a, false AS e FROM l
  UNION ALL SELECT second, key, 0, true, exact FROM r) GROUP BY 1, 2)"""


def _one_sided_sql(level: str, condition: str) -> str:
    return f"""SELECT '{level}' AS level, {text('b')} AS window_start,
  {text(f"(b + INTERVAL 1 {level})")} AS window_end_exclusive,
  CASE WHEN docs > 0 THEN 'ES_ONLY' ELSE 'ATHENA_ONLY' END AS source, key
FROM (SELECT date_trunc('{level}', second) AS b, key, SUM(docs) AS docs, bool_or(lake_exact) AS lake_exact
  FROM rows WHERE {condition} GROUP BY 1, 2)
WHERE key IS NOT NULL AND (docs > 0) <> lake_exact"""


@query(
    "pipe_reconcile_exact",
    ("stage", "index_docs"),
    f", {EXACT_SQL} {_one_sided_sql('month', 'true')}",
)
def pipe_reconcile_exact(f: Fixtures) -> DataFrame:
    return plans.reconcile_exact(f.index_docs, f.stage, ENTITY, YEARS)


@query(
    "pipe_reconcile_sketched",
    ("stage", "index_docs"),
    f", {EXACT_SQL} {_one_sided_sql('month', 'true')}",
)
def pipe_reconcile_sketched(f: Fixtures) -> DataFrame:
    return plans.reconcile_sketched(f.index_docs, f.stage, ENTITY, YEARS)


@query(
    "pipe_reconcile_exact_indexed",
    ("stage", "index_docs"),
    f", {EXACT_SQL} {_one_sided_sql('month', 'true')}",
)
def pipe_reconcile_exact_indexed(f: Fixtures) -> DataFrame:
    return plans.reconcile_exact(_postings(f), f.stage, ENTITY, YEARS)


THRESHOLD = 20  # low enough that the test data is drilled through several levels


def _drill_sql(threshold: int) -> tuple[str, str]:
    """CTEs for the five levels, and the final query over their leaves."""
    ctes, leaves, above, stats = [], [], "true", []
    for level in fn.LEVELS:
        lake = "lake_any" if level == "month" else "lake_exact"
        ctes.append(f"""f_{level} AS (SELECT b, SUM(docs) AS left_n,
  COUNT(*) FILTER (WHERE key IS NOT NULL AND lake) AS right_n
FROM (SELECT date_trunc('{level}', second) AS b, key, SUM(docs) AS docs, bool_or({lake}) AS lake,
    bool_or(lake_exact) AS exact
  FROM rows WHERE {above} GROUP BY 1, 2) GROUP BY 1
HAVING SUM(docs) <> COUNT(*) FILTER (WHERE key IS NOT NULL AND lake)
  OR bool_or(key IS NOT NULL AND (docs > 0) <> exact))""")
        leaf = "true" if level == "second" else f"left_n < {threshold}"
        leaves.append(
            _one_sided_sql(
                level, f"date_trunc('{level}', second) IN (SELECT b FROM f_{level} WHERE {leaf})"
            )
        )
        stats.append(f"SELECT 'mismatched_{level}' AS counter, COUNT(*) AS n FROM f_{level}")
        above = f"date_trunc('{level}', second) IN (SELECT b FROM f_{level} WHERE NOT ({leaf}))"
    found = "found AS (" + "\nUNION ALL ".join(leaves) + ")"
    return ", " + ",\n".join([EXACT_SQL, *ctes, found]), "\nUNION ALL ".join(stats)


DRILL, LEVEL_COUNTS = _drill_sql(THRESHOLD)


@query("pipe_reconcile", ("stage", "index_docs"), f"{DRILL} SELECT * FROM found")
def pipe_reconcile(f: Fixtures) -> DataFrame:
    return plans.reconcile(f.index_docs, f.stage, ENTITY, YEARS, THRESHOLD).outstanding


@query("pipe_run_reconcile", ("stage", "index_docs"), f"{DRILL} SELECT * FROM found")
def pipe_run_reconcile(f: Fixtures) -> DataFrame:
    root = scratch_path(f.spark, "reconcile-runs")
    for years in (YEARS[:3], YEARS):
        plans.run_reconcile(f.index_docs, f.stage, ENTITY, years, root, threshold=THRESHOLD)
    found, _ = plans.run_reconcile(f.index_docs, f.stage, ENTITY, YEARS, root, threshold=THRESHOLD)
    return found.drop("year")


@query("pipe_reconcile_stored", ("stage", "index_docs"), f"{DRILL} SELECT * FROM found")
def pipe_reconcile_stored(f: Fixtures) -> DataFrame:
    docs, stage, root = (scratch_path(f.spark, name) for name in ("index-docs", "stage-files", "pyramid"))
    for part in (0, 1):
        f.index_docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == part).write.mode("append").parquet(docs)
        half = f.stage.where(F.pmod(F.xxhash64("key"), F.lit(2)) == part)
        half.write.mode("append").partitionBy("reporting_entity").parquet(stage)
        plans.grow_pyramid(f.spark, docs, stage, ENTITY, root)
    return plans.reconcile_stored(f.spark, ENTITY, YEARS, root, THRESHOLD).outstanding


@query(
    "agg_level_stats",
    ("stage", "index_docs"),
    f"""{DRILL} SELECT counter, n FROM (SELECT 'keys_' || source AS counter, COUNT(*) AS n FROM found GROUP BY 1
UNION ALL {LEVEL_COUNTS}) WHERE n > 0""",
)
def agg_level_stats(f: Fixtures) -> DataFrame:
    result = plans.reconcile(f.index_docs, f.stage, ENTITY, YEARS, THRESHOLD)
    return aggregates.level_stats(result.mismatches, result.outstanding)


LOOKUP_SQL = f""", {PAIRS},
p AS (SELECT source_id, key, {KEY_QUAD} AS quadrimester FROM pairs WHERE key IS NOT NULL
  AND source_id IN (SELECT source_id FROM id_list)),
c AS (SELECT source_id, quadrimester, COUNT(*) AS n FROM stage WHERE reporting_entity = '{ENTITY}' GROUP BY 1, 2)
SELECT p.source_id, key, p.quadrimester, CASE WHEN p.quadrimester IS NOT NULL THEN COALESCE(n, 0) END AS lake_count,
  CASE WHEN p.quadrimester IS NULL THEN 'QUADRIMESTER_DERIVE' END AS stage,
  CASE WHEN p.quadrimester IS NULL THEN 'no year and month at the start of the key: ' || key END AS error,
  CASE WHEN p.quadrimester IS NULL THEN 'failed' ELSE 'resolved' END AS outcome
FROM p LEFT JOIN c ON p.source_id = c.source_id AND p.quadrimester = c.quadrimester
UNION ALL
SELECT DISTINCT source_id, NULL, NULL, NULL, NULL, NULL, 'unresolved' FROM id_list
WHERE source_id NOT IN (SELECT source_id FROM p)"""


@query("pipe_source_lookup", ("stage", "index_docs", "id_list"), LOOKUP_SQL)
def pipe_source_lookup(f: Fixtures) -> DataFrame:
    return plans.lookup_sources(f.id_list, f.index_docs, f.stage, ENTITY)


@query("pipe_source_lookup_indexed", ("stage", "index_docs", "id_list"), LOOKUP_SQL)
def pipe_source_lookup_indexed(f: Fixtures) -> DataFrame:
    return plans.lookup_sources(f.id_list, _postings(f), f.stage, ENTITY)


@query("pipe_dedup_month", ("stage",), f", {DEDUP} SELECT * FROM dedup")
def pipe_dedup_month(f: Fixtures) -> DataFrame:
    return _dedup(f)


@query(
    "pipe_dedup_quadrimester",
    ("stage",),
    f", {DEDUP.replace('PARTITION BY quadrimester, month(ts), source_id', 'PARTITION BY quadrimester, source_id')}"
    " SELECT * FROM dedup",
)
def pipe_dedup_quadrimester(f: Fixtures) -> DataFrame:
    return plans.dedup(f.stage, ENTITY, LABELS_OF_YEARS, scope="quadrimester")


VERIFY = f"""{DEDUP},
t AS (SELECT quadrimester, COUNT(*) AS t_rows, COUNT(DISTINCT source_id) AS t_ids FROM dedup GROUP BY 1),
s AS (SELECT quadrimester, COUNT(DISTINCT source_id) AS s_ids FROM stage
  WHERE reporting_entity = '{ENTITY}' AND quadrimester IN ({YEAR_QUADS}) GROUP BY 1),
verified AS (SELECT quadrimester, COALESCE(t_rows, 0) AS temp_total_rows, COALESCE(t_ids, 0) AS temp_distinct_sources,
  COALESCE(s_ids, 0) AS stage2_distinct_sources, COALESCE(t_ids, 0) - COALESCE(s_ids, 0) AS delta,
  CASE WHEN COALESCE(t_ids, 0) = COALESCE(s_ids, 0) THEN 'pass' ELSE 'mismatch' END AS status,
  COALESCE(t_rows, 0) <> COALESCE(t_ids, 0) AS note
FROM t FULL JOIN s USING (quadrimester))"""


@query("pipe_verify", ("stage",), f", {VERIFY} SELECT * FROM verified")
def pipe_verify(f: Fixtures) -> DataFrame:
    return plans.verify(_dedup(f), f.stage, ENTITY, LABELS_OF_YEARS)


@query(
    "pipe_migrate",
    ("stage",),
    f""", {VERIFY} SELECT quadrimester, CASE status WHEN 'pass' THEN 'published' ELSE 'mismatch' END AS outcome,
  CAST(NULL AS VARCHAR) AS error FROM verified""",
)
def pipe_migrate(f: Fixtures) -> DataFrame:
    root = scratch_path(f.spark, "migrate")
    f.spark.sql(f"DROP TABLE IF EXISTS {table_name(ENTITY)}")
    return plans.migrate(f.spark, f.stage, ENTITY, YEARS, root, wave=len(LABELS_OF_YEARS))


@query(
    "audit_mistagged",
    ("stage",),
    f"""SELECT {STAGE_COLUMNS}, {quad(TS)} AS expected_quadrimester FROM stage
WHERE quadrimester NOT IN ('pre-1970', '1970-1999', 'post-2026') AND quadrimester <> {quad(TS)}""",
)
def audit_mistagged(f: Fixtures) -> DataFrame:
    return plans.mistagged_rows(f.stage)


@query("audit_undated", ("stage",), f"SELECT {STAGE_COLUMNS} FROM stage WHERE {TS} IS NULL")
def audit_undated(f: Fixtures) -> DataFrame:
    return plans.undated_rows(f.stage)
