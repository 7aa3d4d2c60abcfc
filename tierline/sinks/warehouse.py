"""Parquet tables below one root path.

Every write of a table goes to a folder of its own, and a list of visible folders then shows it
(``tierline.sinks.manifest``): a write is seen as a whole or not at all, whatever it replaces, and a writer that
dies leaves the old rows. A plan may read the table it is about to replace; the last few states stay on disk.
Tables that are only appended to are plain directories of Parquet files.

Dimensions are stored in hash buckets of their key. A step writes the buckets it changes and leaves the others.
"""

from __future__ import annotations

import datetime as dt
import uuid
import zlib
from collections import Counter
from collections.abc import Collection, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.model import TABLES, Table
from tierline.sinks.manifest import WRITE, Files, Manifest, values_of

BUCKET = "bucket"
# Seconds that an unfinished write may take before ``clean`` removes it.
UNFINISHED = 7 * 24 * 3600


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        tables: Mapping[str, Table] = TABLES,
        aliases: Mapping[str, str] | None = None,
    ):
        """``aliases`` renames tables on disk and in the catalog, e.g. to names already in use."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = tables
        self.aliases = dict(aliases or {})
        self.files = Files(spark, self.root)

    def create(self) -> None:
        """Make the directories of appended tables that have none yet, so that each can be read."""
        for name, table in self.tables.items():
            if table.layout == "append":
                self._empty(table.schema).write.mode("ignore").parquet(self.path(name))

    # Reading

    def path(self, name: str) -> str:
        return f"{self.root}/{self.aliases.get(name, name).replace('.', '/')}"

    def manifest(self, name: str) -> Manifest:
        return Manifest(self.files, self.path(name))

    def read(self, name: str, only: Mapping[str, Collection[object]] | None = None) -> DataFrame:
        """The visible rows of a table with its declared schema; no rows before the first write.

        ``only`` names values of partition columns; folders with others are not even listed.
        """
        table = self.tables[name]
        if table.layout == "append":
            return self._parquet([self.path(name)], table.schema, self.path(name)).select(*table.schema.names)
        folders = self._folders(name, only)
        hidden = [T.StructField(k, T.StringType()) for k in (WRITE, *_partition(table)) if k not in table.schema.names]
        schema = T.StructType([*table.schema.fields, *hidden])
        paths = [f"{self.path(name)}/{f}" for f in folders]
        return self._parquet(paths, schema, self.path(name)).select(*table.schema.names)

    def partitions(self, name: str, only: Mapping[str, Collection[object]] | None = None) -> list[dict[str, str]]:
        """Partition values, as text, of a table's visible folders; reads no data."""
        return [values_of(f) for f in self._folders(name, only)]

    def _folders(self, name: str, only: Mapping[str, Collection[object]] | None) -> list[str]:
        wanted = {k: {_text(v) for v in values} for k, values in (only or {}).items()}
        found = self.manifest(name).folders()
        return [f for f in found if all(values_of(f)[k] in values for k, values in wanted.items())] if wanted else found

    def history(self, name: str, buckets: Collection[int] | None = None) -> DataFrame:
        """Closed rows of a versioned dimension."""
        return self.read(name, {"is_current": [False]} | _only(buckets)).where(~F.col("is_current"))

    def current(self, name: str, buckets: Collection[int] | None = None) -> DataFrame:
        """Open rows of a versioned dimension; reads their folders alone."""
        return self.read(name, {"is_current": [True]} | _only(buckets)).where("is_current")

    def version(self, name: str) -> int:
        """Number of the visible state of a table; 0 before the first write."""
        return self.manifest(name).latest()[0]

    def bucket(self, name: str) -> Column:
        """The bucket of a dimension's key."""
        table = self.tables[name]
        return F.pmod(F.xxhash64(F.col(table.key).cast(table.schema[table.key].dataType)), F.lit(table.buckets)).cast("int")

    def buckets_of(self, name: str, keys: DataFrame) -> list[int]:
        """Buckets that hold some of these keys; at most as many numbers as the table has buckets."""
        return sorted(r[0] for r in keys.select(self.bucket(name).alias(BUCKET)).distinct().collect())

    def _parquet(self, paths: Sequence[str], schema: T.StructType, base: str) -> DataFrame:
        if not paths:
            return self._empty(schema)
        try:
            return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND" and list(paths) == [base]:
                return self._empty(schema)
            raise

    def _empty(self, schema: T.StructType) -> DataFrame:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        # Not a constant condition: a plan without any scan would drop the counts observed on it.
        return self.spark.range(1).where(F.rand(0) > 1).select(*nothing)

    # Writing; each method returns the number of rows written

    def write_append(self, name: str, df: DataFrame) -> int:
        """Add rows (K3)."""
        rows, count = self._counted(name, df)
        rows.write.mode("append").parquet(self.path(name))
        return count()

    def append_row(self, name: str, row: Mapping[str, object]) -> None:
        """Add one row made by the driver, such as a line of the audit log."""
        self.row(name, row).write.mode("append").parquet(self.path(name))

    def row(self, name: str, row: Mapping[str, object]) -> DataFrame:
        """A row of a table made by the driver; columns that are not given are null."""
        schema = TABLES[name].schema if name in TABLES else self.tables[name].schema
        # Literals stay in the JVM; a frame from Python objects would take several times as long.
        values = [
            F.lit(None if row.get(f.name) is None else str(row[f.name])).cast(f.dataType).alias(f.name)
            for f in schema
        ]
        return self.spark.range(0, 1, 1, 1).select(*values)

    def write_replace_partition(self, name: str, df: DataFrame, day: dt.date) -> int:
        """Replace the rows of one day (K1, K4); an empty frame clears the day."""
        key, *more = self.tables[name].partition
        rows = df.withColumn(key, F.lit(day))
        return self._write(name, rows, {key: {day}}, spread=more)

    def write_run(self, name: str, df: DataFrame, **run: str) -> int:
        """Replace the rows of one run (K3, V11), named by its value for each partition column.

        A run that is repeated replaces all it wrote before, also if it has no rows now.
        """
        rows = df.withColumns({k: F.lit(v) for k, v in run.items()})
        return self._write(name, rows, {k: {v} for k, v in run.items()})

    def write_full(self, name: str, df: DataFrame) -> int:
        """Replace a table (K2)."""
        return self._write(name, df, {}, spread=_partition(self.tables[name]))

    def write_versions(self, name: str, df: DataFrame, buckets: Collection[int] | None = None) -> int:
        """Store the current rows of these buckets, or of all, and the rows closed by this step of a dimension.

        Rows closed by earlier steps, and other buckets, stay in their own folders and are not rewritten.
        """
        return self._write(name, df, {"is_current": {True}} | _only(buckets), spread=[BUCKET])

    def write_buckets(self, name: str, df: DataFrame, buckets: Collection[int]) -> int:
        """Replace the rows of these buckets of a table without versions (K6)."""
        return self._write(name, df, _only(buckets), spread=[BUCKET])

    def write_more(self, name: str, df: DataFrame) -> int:
        """Add rows to a bucketed table; its next change of a bucket puts the bucket's files together."""
        return self._write(name, df, None, spread=[BUCKET])

    def compact(self, name: str, most: int) -> list[int]:
        """Put the folders of each bucket of a table without versions together that has more than ``most``."""
        folders = Counter(int(v[BUCKET]) for v in self.partitions(name))
        full = sorted(b for b, n in folders.items() if n > most)
        if full:
            self.write_buckets(name, self.read(name, _only(full)), full)
        return full

    def write_dates(self, name: str, df: DataFrame, dates: DataFrame | Collection[object]) -> int:
        """Replace the rows of all ``dates`` (K5), also of those for which ``df`` has none.

        A date may hold much of the data; rebalancing splits it over several files and tasks.
        """
        (key,) = self.tables[name].partition
        # A list of days, not of rows.
        wanted = {r[0] for r in dates.select(key).distinct().collect()} if isinstance(dates, DataFrame) else set(dates)
        return self._write(name, df, {key: wanted}, spread=[key], replace_written=True)

    def _write(
        self,
        name: str,
        df: DataFrame,
        gone: Mapping[str, Collection[object]] | None,
        spread: Sequence[str] = (),
        replace_written: bool = False,
    ) -> int:
        """Write a folder and show it in place of the folders whose partition values are all in ``gone``.

        None hides nothing. ``spread`` names partition columns by which rows are dealt, so that a folder has
        few files; ``replace_written`` also hides other folders with the values of the first key that were written.
        """
        table = self.tables[name]
        keys = _partition(table)
        rows, count = self._counted(name, df, BUCKET if BUCKET in keys else None, spread)
        write = f"{WRITE}=w{uuid.uuid4().hex}"
        rows.write.partitionBy(*keys).parquet(f"{self.path(name)}/{write}")
        new = self._leaves(name, write, len(keys))
        hidden = {k: {_text(v) for v in values} for k, values in (gone or {}).items()}
        if replace_written:
            hidden[keys[0]] |= {values_of(f)[keys[0]] for f in new}

        def stays(folder: str) -> bool:
            values = values_of(folder)
            return gone is None or not all(values[k] in some for k, some in hidden.items())

        self.manifest(name).exchange(lambda folders: [*filter(stays, folders), *new])
        return count()

    def _leaves(self, name: str, folder: str, depth: int) -> list[str]:
        """Partition folders below one that was just written; itself if the table has no partitions."""
        if not depth:
            return [folder]
        inner = [n for n in self.files.names(f"{self.path(name)}/{folder}") if "=" in n and n[0] not in "._"]
        return [leaf for n in inner for leaf in self._leaves(name, f"{folder}/{n}", depth - 1)]

    def _counted(self, name: str, df: DataFrame, bucket: str | None = None, spread: Sequence[str] = ()):
        """The columns of the table in order, and a function for the count once they are written."""
        columns = [F.col(f.name).cast(f.dataType) for f in self.tables[name].schema]
        seen = Observation()
        rows = df.select(*columns, *([self.bucket(name).alias(bucket)] if bucket else []))
        if spread:
            rows = rows.hint("rebalance", *spread)
        # Last, because adaptive execution drops what is below a shuffle of no rows.
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        return rows, lambda: int(seen.get["n"])

    def clean(self, older_than: float = UNFINISHED) -> list[str]:
        """Remove what writers that died have left, if it is older than so many seconds; returns the folders."""
        return [
            f"{name}/{folder}"
            for name, table in self.tables.items()
            if table.layout != "append"
            for folder in self.manifest(name).clean(older_than)
        ]

    def stage(self, df: DataFrame, path: str) -> DataFrame:
        """Write an intermediate result once and read it back with its true size and no lineage."""
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # Catalog

    def register(self, schemas: Sequence[str] = ("gold", "silver", "metadata", "bronze")) -> None:
        """Make the visible state of all tables known to SQL, as ``gold.dim_video`` and as
        ``dim_video``; a bare name goes to the first schema in order that has it."""
        taken: set[str] = set()
        for schema in schemas:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{self.root}/{schema}'")
            for name in self.tables:
                if name.split(".")[0] != schema:
                    continue
                shown = self.aliases.get(name, name)
                self._show(name, shown)
                bare = shown.split(".")[1]
                if bare not in taken:
                    self.read(name).createOrReplaceTempView(bare)
                    taken.add(bare)

    def _show(self, name: str, shown: str) -> None:
        """Point a view at the visible folders, which are partitions of a table named by the state's number and place."""
        table = self.tables[name]
        number, folders = (0, []) if table.layout == "append" else self.manifest(name).latest()
        keys = () if table.layout == "append" else (WRITE, *_partition(table))
        types = {f.name: f.dataType.simpleString() for f in table.schema}
        columns = ", ".join(f"{c} {t}" for c, t in ({k: "string" for k in keys} | types).items())
        files = f"{shown}__files_{number}_{zlib.crc32(self.path(name).encode())}"
        by = f"PARTITIONED BY ({', '.join(keys)}) " if keys else ""
        # Without folders it is a table without partitions, which has no rows.
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {files} ({columns}) USING parquet {by}LOCATION '{self.path(name)}'")
        for some in range(0, len(folders), 200):
            parts = " ".join(
                f"PARTITION ({_spec(values_of(f))}) LOCATION {_literal(f'{self.path(name)}/{f}')}" for f in folders[some : some + 200]
            )
            self.spark.sql(f"ALTER TABLE {files} ADD IF NOT EXISTS {parts}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {shown} AS SELECT {', '.join(types)} FROM {files}")
        schema, bare = shown.split(".")
        for row in self.spark.sql(f"SHOW TABLES IN {schema} LIKE '{bare}__files_*'").collect():
            if row["tableName"] != files.split(".")[1].lower():
                self.spark.sql(f"DROP TABLE {schema}.{row['tableName']}")


def _partition(table: Table) -> tuple[str, ...]:
    """Columns by which a table's folders are named."""
    if table.layout == "versions":
        return ("is_current", BUCKET)
    return (BUCKET,) if table.layout == "keyed" else table.partition


def _only(buckets: Collection[int] | None) -> dict[str, Collection[object]]:
    return {} if buckets is None else {BUCKET: buckets}


def _text(value: object) -> str:
    """A partition value as it stands in a folder's name."""
    if isinstance(value, bool):
        return str(value).lower()
    return value.isoformat() if isinstance(value, dt.date) else str(value)


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _spec(values: Mapping[str, str]) -> str:
    return ", ".join(f"{k}={_literal(v)}" for k, v in values.items())
