"""The two archive copies, derived from the driver's tables in Spark and in SQL.

All rows of `lineitem` and `documents` take part. Differences between the copies
follow from ordinary column values (discount, tax, quantity), described in
FIXTURES.md. Times are shifted by twenty years so that most rows fall into the
regular quadrimesters of 2015-2021.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger import configure, schemas
from twinledger.functions import epoch_ts, key_month

TABLES = ("lineitem", "orders", "documents")
ENTITY = "entity.a.com"
YEARS = list(range(2015, 2022))

# Mails of two languages fall far outside the years of the archive rows, by
# thirteen years back and ten ahead, and some are archived in 2027.
MAIL_SHIFT = "CASE lang WHEN 'fr' THEN -410227200 WHEN 'es' THEN 315532800 ELSE 0 END"
ARCHIVE_SHIFT = "CASE lang WHEN 'es' THEN 136000000 ELSE 0 END"

# SQL shared by both engines; {...} are the calls whose spelling differs.
_VIEWS = {
    "archive": """
SELECT *, {ts_s} AS ts, 'SRC-' || CAST(l_orderkey AS STRING) AS src,
  {date_path} || '/' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '.gz' AS path,
  'M' || CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) AS message_id,
  CAST(s * 1000 + l_partkey % 1000 AS STRING) AS ms
FROM (SELECT *, 'entity.' || LOWER(l_returnflag) || '.com' AS reporting_entity,
    {shipdate_s} + 631152000 + (l_orderkey * 7919 + l_linenumber * 104729) % 86400 AS s
  FROM lineitem) b
""",
    "stage": """
SELECT reporting_entity,
  CASE WHEN month(ts) = 12 AND day(ts) >= 29 AND l_linestatus = 'F'
    THEN CAST(year(ts) + 1 AS STRING) || '-T1' ELSE {quad} END AS quadrimester,
  CASE WHEN l_quantity < 1.5 AND l_tax > 0.075 THEN NULL ELSE src END AS source_id,
  path AS key, message_id, {stamp} AS time_stamp,
  CASE WHEN l_quantity < 1.5 AND l_discount > 0.095 THEN 'n/a' ELSE ms END AS start_time
FROM archive
UNION ALL
SELECT reporting_entity, {quad}, src, path, message_id, {stamp_next_day}, ms
FROM archive WHERE l_tax > 0.075 AND l_discount > 0.095
UNION ALL
SELECT reporting_entity,
  CASE WHEN {legacy_year} < 2000 THEN '1970-1999' ELSE CAST({legacy_year} AS STRING) || {legacy_third} END,
  src, 'legacy/' || path, message_id, {stamp}, CAST((s - 631152000) * 1000 AS STRING)
FROM archive WHERE l_tax < 0.005 AND l_discount < 0.005
UNION ALL
SELECT reporting_entity, CASE WHEN l_linestatus = 'F' THEN '2027-T1' ELSE NULL END,
  src, 'later/' || path, message_id, {stamp}, CAST((s + 378691200) * 1000 AS STRING)
FROM archive WHERE l_quantity > 49.5 AND l_tax < 0.005
""",
    "index_docs": """
SELECT k || '#' || message_id || '#' || CAST(l_partkey AS STRING) || copy AS doc_id,
  CASE WHEN l_quantity < 1.5 AND l_tax > 0.075 THEN 'lost/' || k ELSE k END AS key,
  'X-SOURCE-ID:' || src || ' X-REPORTING-ENTITY: ' || reporting_entity || ' ' || message_id AS content,
  {start_ts} AS start_ts, {archived_ts} AS archived_ts
FROM (
  SELECT *, path AS k, 'a' AS copy FROM archive WHERE NOT (l_discount < 0.005 AND l_tax > 0.075)
  UNION ALL SELECT *, path || '.x', 'x' FROM archive WHERE l_discount > 0.095 AND l_tax < 0.005
  UNION ALL SELECT *, path, 'd' FROM archive
    WHERE l_quantity > 49.5 AND NOT (l_discount < 0.005 AND l_tax > 0.075)) u
UNION ALL
SELECT 'mail-' || CAST(doc_id AS STRING),
  CASE WHEN lang = 'de' THEN NULL ELSE {mail_path} || '/mail-' || CAST(doc_id AS STRING) || '.eml' END,
  text || chr(10) || 'X-SOURCE-ID:MAIL-' || CAST(doc_id AS STRING) || chr(10)
    || 'X-REPORTING-ENTITY: entity.a.com' || chr(10) || text || chr(10)
    || 'X-SOURCE-ID: MAIL-' || CAST(doc_id + 1 AS STRING),
  {mail_ts}, {mail_archived_ts}
FROM documents
""",
    "key_list": """
SELECT key FROM stage UNION ALL SELECT 'doc/' || CAST(doc_id AS STRING) FROM documents
""",
    "id_list": """
SELECT 'SRC-' || CAST(o_orderkey AS STRING) AS source_id FROM orders
UNION ALL SELECT 'MAIL-' || CAST(doc_id AS STRING) FROM documents
""",
}

_NEEDS = {
    "archive": (),
    "stage": ("archive",),
    "index_docs": ("archive",),
    "key_list": ("stage",),
    "id_list": (),
}

_SPARK = {
    "shipdate_s": "unix_seconds(CAST(l_shipdate AS TIMESTAMP))",
    "ts_s": "timestamp_seconds(s)",
    "date_path": "date_format(timestamp_seconds(s), 'yyyy/MM/dd')",
    "quad": "date_format(ts, 'yyyy') || '-T' || CAST(CEIL(month(ts) / 4) AS STRING)",
    "stamp": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")",
    "stamp_next_day": "date_format(timestamp_seconds(s + 86400), \"yyyy-MM-dd'T'HH:mm:ss\")",
    "legacy_year": "year(timestamp_seconds(s - 631152000))",
    "legacy_third": "'-T' || CAST(CEIL(month(timestamp_seconds(s - 631152000)) / 4) AS STRING)",
    "start_ts": "timestamp_millis(CAST(ms AS BIGINT))",
    "archived_ts": "timestamp_millis(CAST(ms AS BIGINT) + 157766400000)",
    "mail_path": "date_format(timestamp_seconds(1514764800 + doc_id * 600), 'yyyy/MM/dd')",
    "mail_ts": "timestamp_micros((1514764800 + doc_id * 600 + " + MAIL_SHIFT + ") * 1000000 - 500)",
    "mail_archived_ts": "timestamp_seconds(1672531200 + doc_id * 6000 + " + ARCHIVE_SHIFT + ")",
}

_DUCKDB = {
    "shipdate_s": "CAST(epoch(l_shipdate) AS BIGINT)",
    "ts_s": "make_timestamp(s * 1000000)",
    "date_path": "strftime(make_timestamp(s * 1000000), '%Y/%m/%d')",
    "quad": "strftime(ts, '%Y') || '-T' || CAST(CAST(CEIL(month(ts) / 4.0) AS INT) AS STRING)",
    "stamp": "strftime(ts, '%Y-%m-%dT%H:%M:%S')",
    "stamp_next_day": "strftime(make_timestamp((s + 86400) * 1000000), '%Y-%m-%dT%H:%M:%S')",
    "legacy_year": "year(make_timestamp((s - 631152000) * 1000000))",
    "legacy_third": "'-T' || CAST(CAST(CEIL(month(make_timestamp((s - 631152000) * 1000000)) / 4.0) AS INT) AS STRING)",
    "start_ts": "make_timestamp(CAST(ms AS BIGINT) * 1000)",
    "archived_ts": "make_timestamp((CAST(ms AS BIGINT) + 157766400000) * 1000)",
    "mail_path": "strftime(make_timestamp((1514764800 + doc_id * 600) * 1000000), '%Y/%m/%d')",
    "mail_ts": "make_timestamp((1514764800 + doc_id * 600 + " + MAIL_SHIFT + ") * 1000000 - 500)",
    "mail_archived_ts": "make_timestamp((1672531200 + doc_id * 6000 + " + ARCHIVE_SHIFT + ") * 1000000)",
}


def _closure(names: tuple[str, ...]) -> list[str]:
    wanted: list[str] = []
    for name in names:
        for need in (*_closure(_NEEDS[name]), name):
            if need not in wanted:
                wanted.append(need)
    return wanted


def duckdb_with(*names: str) -> str:
    """WITH clause defining the named views for DuckDB."""
    parts = [f"{n} AS ({_VIEWS[n].format(**_DUCKDB).strip()})" for n in _closure(names)]
    return "WITH " + ",\n".join(parts)


class Fixtures:
    """The fixture views as DataFrames over one directory of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _view(self, name: str) -> DataFrame:
        sources = {t: self.table(t) for t in TABLES} | {
            n: getattr(self, n) for n in _NEEDS[name]
        }
        text = _VIEWS[name].format(**_SPARK)
        # {name} in the SQL text becomes the DataFrame passed under that name.
        for source in sources:
            text = text.replace(f"FROM {source}", f"FROM {{{source}}}")
        used = {n: df for n, df in sources.items() if f"{{{n}}}" in text}
        return self.spark.sql(text, **used)

    @cached_property
    def archive(self) -> DataFrame:
        return self._view("archive")

    @cached_property
    def stage(self) -> DataFrame:
        return self._view("stage")

    @cached_property
    def index_docs(self) -> DataFrame:
        return self._view("index_docs")

    @cached_property
    def key_list(self) -> DataFrame:
        return self._view("key_list")

    @cached_property
    def id_list(self) -> DataFrame:
        return self._view("id_list")

    @cached_property
    def dated_stage(self) -> DataFrame:
        """Stage with its time as a timestamp column."""
        return self.stage.withColumn("ts", epoch_ts(F.col("start_time")))


class StoredFixtures(Fixtures):
    """The same views written once in the layout of the real copies: the stage
    partitioned by entity and quadrimester, the index by key month."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        super().__init__(spark, sf_dir)
        self.root = root

    def store(self) -> StoredFixtures:
        views = Fixtures(self.spark, self.dir)
        views.stage.hint(
            "rebalance", F.col("reporting_entity"), F.col("quadrimester")
        ).write.partitionBy("reporting_entity", "quadrimester").parquet(f"{self.root}/stage")
        views.index_docs.withColumn("key_month", key_month(F.col("key"))).hint(
            "rebalance", F.col("key_month")
        ).write.partitionBy("key_month").parquet(f"{self.root}/index_docs")
        views.key_list.write.parquet(f"{self.root}/key_list")
        views.id_list.write.parquet(f"{self.root}/id_list")
        return self

    def _stored(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    @cached_property
    def stage(self) -> DataFrame:
        return self._stored("stage", schemas.STAGE)

    @cached_property
    def index_docs(self) -> DataFrame:
        return self._stored("index_docs", schemas.INDEX_BY_MONTH)

    @cached_property
    def key_list(self) -> DataFrame:
        return self._stored("key_list", "key string")

    @cached_property
    def id_list(self) -> DataFrame:
        return self._stored("id_list", "source_id string")
