"""File scans into all-string frames (S1, S2, S3). Schemas are always given, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEMS_DOCUMENT = T.StructType(
    [
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField(
                            "snippet", T.StructType([T.StructField("title", T.StringType())])
                        ),
                    ]
                )
            ),
        )
    ]
)


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv_bronze(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True, place: bool = False
) -> DataFrame:
    """CSV with a header, every field a string, empty fields kept as ``''``.

    Quoted fields may hold line breaks, so a file is one split by default; ``read_csv_split`` splits
    files that quote by the rules. A feed known to have no line breaks in fields can pass
    ``multi_line=False``. ``place`` adds columns for ``in_scan_order``.
    """
    extra = [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    ]
    return (
        spark.read.schema(string_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        # The default limit would reject long text fields.
        .option("maxCharsPerColumn", -1)
        .csv(path)
        .select(*columns, *(extra if place else []))
        .na.fill("", list(columns))
    )


def in_scan_order(rows: DataFrame, name: str) -> DataFrame:
    """Number rows by file path, block and line instead of by task; files of a task may be in any order.

    ``rows`` must be stored, so that a row keeps its ``_file``, ``_block`` and ``_at``. One row per block is ranked.
    """
    blocks = rows.groupBy("_file", "_block").agg(F.min("_at").alias("_first"))
    rank = F.row_number().over(Window.orderBy("_file", "_block"))
    ranked = blocks.withColumn("_rank", rank)
    number = F.shiftleft(F.col("_rank").cast("bigint"), 33) + F.col("_at") - F.col("_first")
    return rows.join(ranked, ["_file", "_block"]).withColumn(name, number).drop(
        "_file", "_block", "_at", "_first", "_rank"
    )


def flatten_items(documents: DataFrame) -> DataFrame:
    """One row per entry of ``items`` that has both an id and a title."""
    entry = documents.select(F.explode("items").alias("item"))
    return entry.select(
        F.col("item.id").alias("category_id"),
        F.col("item.snippet.title").alias("category_title"),
    ).where((F.col("category_id") != "") & (F.col("category_title") != ""))


def read_json_items(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """JSON documents with an ``items`` array (S2); ``multi_line=False`` reads one document per line."""
    documents = (
        spark.read.schema(ITEMS_DOCUMENT)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .json(path)
    )
    return flatten_items(documents)


def read_xml_bronze(
    spark: SparkSession, path: str, row_tag: str, columns: Sequence[str]
) -> DataFrame:
    """Text children of each ``row_tag`` element (S3); an empty child is NULL, a missing one fails."""
    rows = (
        spark.read.format("xml")
        .schema(string_schema(columns))
        .option("rowTag", row_tag)
        .option("ignoreSurroundingSpaces", False)
        .option("mode", "FAILFAST")
        .load(path)
    )

    def text(c: str) -> Column:
        missing = F.raise_error(F.lit(f"an element <{row_tag}> has no <{c}>"))
        child = F.when(F.col(c).isNull(), missing.cast("string")).otherwise(F.col(c))
        return F.nullif(child, F.lit("")).alias(c)

    return rows.select([text(c) for c in columns])
