"""Readers for list files and the two copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger import schemas
from twinledger.functions import first_column, java_trim

# Fixed header words; only the first non-blank line of a file is tested.
KEY_HEADERS = ("_col0", "key", "s3_key", "s3key", "s3 key")
KEY_COUNT_HEADERS = (*KEY_HEADERS, "keys")
ID_HEADERS = ("source_id", "sourceid")


def locate_lines(scan: DataFrame) -> DataFrame:
    """Lines of a text scan with their file and the start of their file split."""
    return scan.select(
        "value",
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
    )


def parse_list(lines: DataFrame, column: str, headers: tuple[str, ...]) -> DataFrame:
    """Located lines -> one value per line with its place in the input.

    A line's place is (file, start of its file split, number of the line in the
    scan task), so no window and no single task ever sees a whole file; the
    first line of each file comes from a minimum combined on the map side. Lines
    that read like a header are compared with it.
    """
    placed = (
        lines.select(
            first_column(java_trim(F.col("value"))).alias(column),
            (java_trim(F.col("value")) == "").alias("blank"),
            "src_file",
            "src_block",
            F.monotonically_increasing_id().alias("src_line"),
        )
        .where(~F.col("blank"))
        .drop("blank")
    )
    place = F.struct("src_block", "src_line")
    # By split first: a least number is kept in a hash table, a least place would sort all lines.
    splits = placed.groupBy("src_file", "src_block").agg(F.min("src_line").alias("src_line"))
    # A row per file, of files that the driver has listed; so the lines are read once more only.
    first = F.broadcast(splits.groupBy("src_file").agg(F.min(place).alias("at")))
    like_header = F.lower(F.col(column)).isin(*headers)
    wanted = (~like_header & (F.col(column) != "")) | (like_header & (place != F.col("at")))
    return placed.join(first, "src_file", "left").where(wanted).select(*placed.columns)


def read_key_list(
    spark: SparkSession, path: str, headers: tuple[str, ...] = KEY_HEADERS
) -> DataFrame:
    return parse_list(locate_lines(spark.read.text(path)), "key", headers)


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_list(locate_lines(spark.read.text(path)), "source_id", ID_HEADERS)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STAGE).parquet(path)


def read_index(spark: SparkSession, path: str, by_month: bool = False) -> DataFrame:
    """Index documents. `by_month`: stored in folders key_month=..., as
    `functions.key_month` gives it; key lookups then skip other months."""
    schema = schemas.INDEX_BY_MONTH if by_month else schemas.INDEX_DOCS
    return spark.read.schema(schema).parquet(path)


def read_dedup(spark: SparkSession, table: str, quadrimester: str) -> DataFrame:
    """One quadrimester of the dedup table; the filter prunes partitions."""
    return spark.table(table).where(F.col("quadrimester") == F.lit(quadrimester))
