"""Values carried by a key path of the form YYYY/MM/..."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANY_MONTH = "all"


def key_month(key: Column) -> Column:
    """Index month 'YYYY-MM' of a key; 'all' when the path does not say."""
    return F.when(
        key.rlike("^[0-9]{4}/[0-9]{2}/"),
        F.concat(F.substring(key, 1, 4), F.lit("-"), F.substring(key, 6, 2)),
    ).otherwise(F.lit(ANY_MONTH))


def quadrimester_of_key(key: Column) -> Column:
    """'YYYY-Tn' of a key, NULL if malformed or the month is not 01..12."""
    month = F.substring(key, 6, 2)
    third = F.when(month <= "04", "1").when(month <= "08", "2").otherwise("3")
    return F.when(
        key.rlike("^[0-9]{4}/(0[1-9]|1[0-2])/"),
        F.concat(F.substring(key, 1, 4), F.lit("-T"), third),
    )
