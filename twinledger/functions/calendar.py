"""Times, calendar buckets, quadrimesters and year buckets as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = ("month", "day", "hour", "minute", "second")

# Fixed label formats, one per drill level.
LABEL_FORMATS = {
    "month": "yyyy-MM",
    "day": "yyyy-MM-dd",
    "hour": "yyyy-MM-dd'T'HH",
    "minute": "yyyy-MM-dd'T'HH:mm",
    "second": "yyyy-MM-dd'T'HH:mm:ss",
}

WINDOW_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Fixed bucket values: quadrimester partitions that stand for several years.
SPECIAL_BUCKETS = ("pre-1970", "1970-1999", "post-2026")
# Rows whose quadrimester belongs to no bucket are counted under this name.
OTHER_BUCKET = "other"

# Last millisecond of year 9999 and first of year 1; beyond, a value is no time.
_MAX_MS = 253_402_300_799_999
_MIN_MS = -62_135_596_800_000


def epoch_ts(start_time: Column) -> Column:
    """Epoch milliseconds held as text -> timestamp in whole seconds, else NULL."""
    ms = start_time.try_cast("bigint")
    sane = F.when(ms.between(_MIN_MS, _MAX_MS), ms)
    return F.timestamp_seconds(F.call_function("div", sane, F.lit(1000).cast("bigint")))


def year_of(ts: Column) -> Column:
    return F.year(ts)


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def time_unit(unit: str, ts: Column) -> Column:
    """The number a level counts by: day of month, hour, minute or second."""
    pick = {"day": F.dayofmonth, "hour": F.hour, "minute": F.minute, "second": F.second}
    if unit not in pick:
        raise ValueError(f"unit {unit!r} is none of {sorted(pick)}")
    return pick[unit](ts)


def bucket_start(level: str, ts: Column) -> Column:
    if level not in LEVELS:
        raise ValueError(f"level {level!r} is none of {LEVELS}")
    return F.date_trunc(level, ts)


def bucket_label(level: str, ts: Column) -> Column:
    return F.date_format(bucket_start(level, ts), LABEL_FORMATS[level])


def window_of(level: str, ts: Column) -> tuple[Column, Column]:
    """Half-open [start, end) of the bucket holding ts."""
    start = bucket_start(level, ts)
    return start, start + F.expr(f"INTERVAL 1 {level.upper()}")


def window_text(ts: Column) -> Column:
    return F.date_format(ts, WINDOW_FORMAT)


def quadrimester_of(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy"), F.lit("-T"), F.ceil(F.month(ts) / 4).cast("string"))


def quadrimester_month(year: Column, month: Column) -> Column:
    """(year, month) -> YYYY-Tn."""
    return F.concat(
        F.lpad(year.cast("string"), 4, "0"), F.lit("-T"), F.ceil(month / 4).cast("string")
    )


def parse_quadrimester(label: Column) -> Column:
    """'2025-T3' -> struct(year, n), NULL for anything else."""
    valid = label.rlike(r"^[0-9]{1,10}-T[1-3]$")
    return F.when(
        valid,
        F.struct(
            F.split_part(label, F.lit("-T"), F.lit(1)).try_cast("int").alias("year"),
            F.split_part(label, F.lit("-T"), F.lit(2)).cast("int").alias("n"),
        ),
    )


def months_of_quadrimester(year: Column, n: Column) -> Column:
    """Array of the four month starts of a quadrimester."""
    first = F.make_date(year, (n - 1) * 4 + 1, F.lit(1))
    return F.sequence(first, F.add_months(first, 3), F.expr("INTERVAL 1 MONTH"))


def literal_tags(ts: Column) -> tuple[Column, Column, Column]:
    """`year`, `quadrimester` and `month` as the text of partition folders."""
    return (
        F.date_format(ts, "yyyy").alias("year"),
        quadrimester_of(ts).alias("quadrimester"),
        F.date_format(ts, "MM").alias("month"),
    )


def expand_years(year: Column) -> Column:
    """Array of the three quadrimester labels of a year."""
    text = F.lpad(year.cast("string"), 4, "0")
    return F.array(*[F.concat(text, F.lit(f"-T{n}")) for n in (1, 2, 3)])


def year_bucket_values(labels: list[str]) -> dict[str, list[str]]:
    """Bucket label -> the quadrimester partition values it covers (`other`: none of its own)."""
    out: dict[str, list[str]] = {}
    for label in (text.strip() for text in labels):
        if not label:
            continue
        if label in SPECIAL_BUCKETS:
            out[label] = [label]
        elif label == OTHER_BUCKET:
            out[label] = []
        elif re.fullmatch(r"[0-9]{4}", label):
            out[label] = [f"{label}-T{n}" for n in (1, 2, 3)]
        else:
            raise ValueError(f"{label!r} is neither a 4-digit year nor one of {(*SPECIAL_BUCKETS, OTHER_BUCKET)}")
    return out


def year_bucket_label(quadrimester: Column) -> Column:
    """The year bucket a quadrimester value belongs to, `other` for anything else."""
    return (
        F.when(quadrimester.isin(*SPECIAL_BUCKETS), quadrimester)
        .when(quadrimester.rlike("^[0-9]{4}-T[1-3]$"), F.substring(quadrimester, 1, 4))
        .otherwise(OTHER_BUCKET)
    )
