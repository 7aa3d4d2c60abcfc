"""Helpers shared by the operators: written tables that cut lineage, row tags, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tierline.session import scratch_dir

# Rows and bytes of one Arrow batch: texts may be long, and a Python worker holds a few batches at once.
BATCH_ROWS = 500
BATCH_BYTES = "16m"


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes that a Python worker gets at once; a setting of the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read again, so that nothing is recomputed.

    A written table survives the loss of executors; see ``tierline.session.scratch_dir``.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Columns = dict[str, list]


def map_columns(df: DataFrame, run: Callable[[Iterator[Columns]], Iterator[Columns]], ddl: str) -> DataFrame:
    """Run a function in Python workers over batches of columns as lists, so that integers keep their nulls."""
    schema = T.StructType.fromDDL(ddl)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(schema)
        columns = ({f: c.to_pylist() for f, c in zip(b.schema.names, b.columns, strict=True)} for b in source)
        for out in run(columns):
            yield pa.RecordBatch.from_arrays([pa.array(out[k.name], k.type) for k in kinds], schema=kinds)

    return df.mapInArrow(batches, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame without these columns, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the edges ``a``, ``b``: one row (node, root) per node, root its smallest.

    Each round merges every node into the smallest of its neighbours and contracts the graph, which at
    least halves the nodes that still have edges. Both tables are written after each round. Nodes may
    be of any type that can be ordered; loops and repeated edges are allowed, nulls are not.
    """
    edges = staged(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = staged(
        edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
        .select("node", F.col("node").alias("root")),
        "labels",
    )
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        up = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")), "up")
        labels = staged(
            labels.join(up, labels["root"] == up["a"], "left")
            .select("node", F.coalesce("up", "root").alias("root")),
            "labels",
        )
        left = edges.join(up, "a").select(F.col("up").alias("x"), "b")
        edges = staged(
            left.join(up, left["b"] == up["a"]).select(F.col("x").alias("a"), F.col("up").alias("b"))
            .where("a <> b").distinct(),
            "edges",
        )
    return labels
