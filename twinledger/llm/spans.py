"""Text spans as columns: arrays of (kind, start, end), in their order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(spans: Column) -> Column:
    return F.sha2(joined(spans), 256)
