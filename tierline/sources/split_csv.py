"""CSV files whose quoted fields hold line breaks, read by many tasks per file.

Spark cuts a text file into blocks at line ends, and a line end may lie inside a quoted field. Whether it does
depends on the number of quotes before it being odd. So the quotes of each block are counted first (one row per
block), their running sums say whether a block begins inside a field, and a second scan puts the lines of every
block together to records. Records that lie in one block never leave their task. Those cut by a block
border are few, at most two pieces per block; a third scan, of the cut blocks only, collects the pieces.

Small blocks share a task, one after the other, so that the number of tasks follows the bytes and not the blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.session import scratch_dir

# Blocks whose list is sent to all tasks, some 100 bytes each; with more, lines are joined and sorted instead.
SENT_BLOCKS = 100_000
# Blocks share a task until it reads about this much, as long as every core has four tasks.
TASK_BYTES = 32 << 20
MIN_PARTITIONS = "spark.sql.files.minPartitionNum"
# Columns of ``_pieces``: the block, the line in it where the record starts (-1: in an earlier block), whether the
# file starts here, and the text.
_PIECE = "_rank bigint, _line bigint, _header boolean, _text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    # Files' lengths come from their list; their content is not read for it.
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return lines.coalesce(max(4 * spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES)))


def _blocks(lines: DataFrame) -> DataFrame:
    """One stored row per block: its rank by file and place, and whether it begins and ends inside a field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("_file", "_block").agg(F.sum(quotes).alias("_quotes"))
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.sum("_quotes").over(in_file)
    ranked = counted.select(
        "_file", "_block", "_quotes",
        F.row_number().over(Window.orderBy("_file", "_block")).cast("bigint").alias("_rank"),
        ((seen - F.col("_quotes")) % 2 == 1).alias("_inside"), (seen % 2 == 1).alias("_open"),
    )
    path = scratch_dir(lines.sparkSession, "csv-blocks")
    ranked.write.parquet(path)
    return lines.sparkSession.read.schema(ranked.schema).parquet(path)


def _located(lines: DataFrame, blocks: DataFrame, few: bool) -> DataFrame:
    """Lines with their block's rank and state, in the order of the files within each task."""
    about = blocks.select("_file", "_block", "_rank", "_inside")
    if few:
        found = lines.join(F.broadcast(about), ["_file", "_block"], "left")
    else:
        found = lines.join(about, ["_file", "_block"], "left").sortWithinPartitions("_file", "_block", "_at")
    lost = F.raise_error(F.lit("the files or their blocks changed while they were read")).cast("bigint")
    return found.select("value", F.coalesce("_rank", lost).alias("_rank"), "_inside", (F.col("_block") == 0).alias("_top"))


def _assemble(batches: Iterator[pa.RecordBatch], cut: bool) -> Iterator[pa.RecordBatch]:
    """Records of consecutive lines; those that a block holds whole, or the pieces of the others (``cut``)."""
    rank, inside, top, line = None, False, False, 0
    held: list[pa.Array] = []
    held_at, begun = 0, True

    def piece(whole: bool, at: int, texts: pa.Array) -> pa.RecordBatch | None:
        if whole == cut or not len(texts):
            return None
        columns = [[rank] * len(texts), range(at, at + 1), [bool(top and at == 0)] * len(texts), texts]
        return _batch(columns)

    def _batch(columns: list) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.bool_(), pa.string())
        arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["_rank", "_line", "_header", "_text"])

    def joined(lines: pa.Array, offsets: np.ndarray) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines), "\n")

    def flush(complete: bool) -> pa.RecordBatch | None:
        """The held lines as one text; a piece unless the record began in this block and is complete."""
        if not held:
            return None
        lines = pa.concat_arrays(held)
        out = piece(begun and complete, held_at if begun else -1, joined(lines, np.array([0, len(lines)])))
        held.clear()
        return out

    for batch in batches:
        ranks = batch.column("_rank").to_numpy()
        ends = [*(np.flatnonzero(np.diff(ranks)) + 1), len(ranks)]
        for a, b in zip([0, *ends], ends, strict=False):
            if a == b:
                continue
            if ranks[a] != rank:
                if (out := flush(False)) is not None:
                    yield out
                rank, line = int(ranks[a]), 0
                inside, top = batch.column("_inside")[a].as_py(), batch.column("_top")[a].as_py()
                begun = not inside
            lines = batch.column("value").slice(a, b - a)
            after = (np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)) + inside) % 2
            # A record ends with each line that leaves the field closed.
            stops = np.flatnonzero(after == 0) + 1
            if len(stops):
                first = int(stops[0])
                if held or not begun:
                    held.append(lines.slice(0, first))
                    held_at = held_at if len(held) > 1 else line
                    if (out := flush(True)) is not None:
                        yield out
                    begun, offsets = True, stops
                else:
                    offsets = np.concatenate([[0], stops])
                if len(offsets) > 1 and not cut:
                    starts = offsets[:-1]
                    texts = joined(lines, offsets)
                    yield _batch([[rank] * len(starts), starts + line, (starts + line == 0) & top, texts])
                rest = lines.slice(int(stops[-1]))
            else:
                rest = lines
            if len(rest):
                if not held:
                    held_at = line + len(lines) - len(rest)
                held.append(rest)
            inside, line = bool(after[-1]), line + len(lines)
    if (out := flush(False)) is not None:
        yield out


def _pieces(located: DataFrame, cut: bool) -> DataFrame:
    return located.mapInArrow(lambda batches: _assemble(batches, cut), _PIECE)


def _stitched(pieces: DataFrame) -> DataFrame:
    """Records cut by block borders, put together from their pieces."""
    path = scratch_dir(pieces.sparkSession, "csv-pieces")
    pieces.write.parquet(path)
    stored = pieces.sparkSession.read.schema(pieces.schema).parquet(path)
    # A piece with no start of its own belongs to the last start before it. The window reads no text.
    so_far = Window.orderBy("_rank", "_line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.last(F.when(F.col("_line") >= 0, F.struct("_rank", "_line", "_header")), True).over(so_far)
    owner = stored.select("_rank", "_line", "_header").withColumn("_start", start).drop("_header")
    texts = F.array_sort(F.collect_list(F.struct("_rank", "_line", "_text")))
    return (
        stored.join(owner, ["_rank", "_line"])
        .groupBy("_start")
        .agg(F.array_join(F.transform(texts, lambda t: t["_text"]), "\n").alias("_text"))
        .select("_start._rank", "_start._line", "_start._header", "_text")
    )


def read_csv_split(spark: SparkSession, path: str, columns: Sequence[str], place: str | None = None) -> DataFrame:
    """CSV with a header, every field a string, empty fields kept as ``''``, each file read by many tasks.

    Fields may hold line breaks if they are quoted, and quotes must be doubled inside quoted fields and absent
    from others (RFC 4180). A file that ends inside a field is refused, and so is a record with another number of
    fields. The rows equal those of ``read_csv_bronze``; ``place`` names a column for the row's place by file path
    and line. Line ends are ``\\n`` or ``\\r\\n``; blank lines are skipped.
    """
    if spark.conf.get(MIN_PARTITIONS, None) is None:
        # The scans must cut the files alike, also while executors come and go.
        spark.conf.set(MIN_PARTITIONS, str(spark.sparkContext.defaultParallelism))
    lines = _lines(spark, path)
    blocks = _blocks(lines)
    ends = F.sum("_quotes").alias("n")
    bad = blocks.groupBy("_file").agg(ends).where("n % 2 = 1").select("_file").limit(3).collect()
    if bad:
        raise ValueError(f"files that end inside a quoted field: {[r['_file'] for r in bad]}")
    n, cut = blocks.agg(F.count("*"), F.count_if(F.col("_inside") | F.col("_open"))).first()
    few = n <= SENT_BLOCKS
    records = _pieces(_located(lines, blocks, few), cut=False)
    if cut:
        broken = blocks.where("_inside OR _open")
        names = broken.select("_file", "_block")
        some = lines.join(F.broadcast(names) if few else names, ["_file", "_block"], "left_semi")
        records = records.union(_stitched(_pieces(_located(some, broken, few), cut=True)))
    return _parsed(records, columns, place)


def _parsed(records: DataFrame, columns: Sequence[str], place: str | None) -> DataFrame:
    text = F.when(F.col("_header"), F.ltrim(F.col("_text"), F.lit("\ufeff"))).otherwise(F.col("_text"))
    text = F.when(text.endswith("\r"), F.left(text, F.length(text) - 1)).otherwise(text)
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "maxCharsPerColumn": "-1", "multiLine": "true"}
    rows = records.withColumn("_text", text).where("_text <> ''")
    rows = rows.withColumn("_row", F.from_csv("_text", schema, options))
    names = F.array(*[F.col("_row")[c] for c in columns])
    other = F.concat(F.lit("the header is not "), F.lit(",".join(columns)), F.lit(": "), F.col("_text"))
    is_row = (
        F.when(~F.col("_header"), True)
        .when(names == F.array(*map(F.lit, columns)), False)
        .otherwise(F.raise_error(other).cast("boolean"))
    )
    fields = [F.coalesce(F.col("_row")[c], F.lit("")).alias(c) for c in columns]
    at = [(F.shiftleft("_rank", 33) + F.col("_line")).alias(place)] if place else []
    return rows.where(is_row).select(*fields, *at)
