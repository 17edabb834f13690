"""Explicit schemas of the inputs and outputs; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


STAGE = _strings(
    "reporting_entity", "quadrimester", "source_id", "key", "message_id", "time_stamp", "start_time"
)

INDEX_DOCS = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("start_ts", T.TimestampType()),
        T.StructField("archived_ts", T.TimestampType()),
    ]
)

INDEX_BY_MONTH = T.StructType(
    [*INDEX_DOCS.fields, T.StructField("key_month", T.StringType())]
)

DEDUP_COLUMNS = ("source_id", "time_stamp", "key", "message_id")
DEDUP_PARTITIONS = ("year", "quadrimester", "month")
DEDUP = _strings(*DEDUP_COLUMNS, *DEDUP_PARTITIONS)

LEDGER = T.StructType(
    [
        T.StructField("unit", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
        T.StructField("job", T.StringType()),
        T.StructField("params", T.StringType()),
    ]
)


def require(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns, refusing missing or differently typed ones."""
    found = {f.name: f.dataType for f in df.schema}
    for field in schema:
        if field.name not in found:
            raise ValueError(f"column {field.name} is missing; found {sorted(found)}")
        if found[field.name] != field.dataType:
            raise ValueError(
                f"column {field.name} is {found[field.name].simpleString()}, "
                f"expected {field.dataType.simpleString()}"
            )
    return df.select(*schema.fieldNames())
