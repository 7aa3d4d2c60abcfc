"""One run from raw feeds to marts. Each step is one lazy plan that ends in one write."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierline import model
from tierline.functions import timestamp
from tierline.functions.times import naive_utc
from tierline.operators.dedupe import latest_per_key, newest_rows, repeated_keys, with_earlier
from tierline.operators.fact import star_join
from tierline.operators.members import (
    inferred_categories,
    inferred_channels,
    inferred_items,
    is_inferred,
    replaced_inferred,
)
from tierline.operators.scd import ABSENT, scd1, scd2, scd2_close, scd2_touched
from tierline.operators.validate import REASON, counted, rejected_records
from tierline.plans import mart_states, marts, silver
from tierline.plans.ledger import RunLedger
from tierline.session import require_utc, scratch_dir, scratch_space
from tierline.sinks.warehouse import BUCKET, Warehouse
from tierline.sources import (
    all_strings,
    in_scan_order,
    read_csv_bronze,
    read_csv_split,
    read_incremental,
    read_json_items,
    read_xml_bronze,
    with_lineage,
)

# Names of the sources in the lineage column, and of the steps in the audit log.
CSV_SOURCE = "USvideos_csv"
JSON_SOURCE = "US_category_id_json"
XML_SOURCE = "channels_xml"
EXTRACT_SOURCE = "postgres_external_db"
BRONZE, SILVER, SCD, GOLD = (
    "bronze_ingestion",
    "silver_validation",
    "scd_processing",
    "gold_mart_building",
)

ITEM_ORDER = ("load_timestamp", "row_seq")
RAW_ITEMS, RAW_CATEGORIES, CHANNELS = "raw_videos", "raw_categories", "consolidated_channels"


@dataclass
class Feeds:
    """Where a run reads from. A feed left out is not landed, and its last content stays in use."""

    items_csv: str | None = None
    categories_json: str | None = None
    channels_xml: str | None = None
    channels_table: DataFrame | None = None
    # Keys of the extract: with them, rows that come late with the time of the last load are landed too.
    channels_keys: tuple[str, ...] | None = None
    # Large files are read by many tasks. A feed with stray quotes needs False, which reads a file as one task.
    csv_split: bool = True


class Pipeline:
    """The steps of a run; ``run`` calls them in order."""

    def __init__(
        self,
        spark: SparkSession,
        warehouse: Warehouse,
        run_id: str,
        run_ts: dt.datetime,
        *,
        full: bool = False,
        across_loads: bool = False,
        on_shared_title: str = "error",
        register: bool = False,
    ):
        """``full`` validates all landed days instead of this run's day. ``across_loads`` judges duplicates
        of a day against all days before it, so that daily runs keep the rows that ``full`` keeps. ``on_shared_title`` says
        what happens when two current channels carry one title: ``error``, or ``first`` to give
        the facts to the channel with the lowest id. ``register`` shows the new state to SQL at the end."""
        require_utc(spark)
        self.spark = spark
        self.wh = warehouse
        self.run_id = run_id
        self.run_ts = naive_utc(run_ts)
        self.day = self.run_ts.date()
        self.full = full
        self.across_loads = across_loads and not full
        self.on_shared_title = on_shared_title
        self.register = register
        self.ledger = RunLedger(warehouse, run_id, "medallion_etl_pipeline", self.run_ts)
        self.counts = {"inserted": 0, "updated": 0, "rejected": 0}

    def run(self, feeds: Feeds) -> dict[str, int]:
        self.wh.create()
        self.ledger.start()
        try:
            with scratch_space(self.spark, "run"):
                self.land(feeds)
                self.clean()
                self.historize()
                self.build()
        except Exception:
            self.ledger.finish("FAILED", **self.counts)
            raise
        self.ledger.finish("SUCCESS", **self.counts)
        if self.register:
            self.wh.register()
        return dict(self.counts)

    def step(self, task: str, name: str, fn) -> None:
        self.ledger.audited(task, name)(fn)()

    # Bronze

    def land(self, feeds: Feeds) -> None:
        if feeds.items_csv:
            self.step(BRONZE, "ingest_csv", lambda: self.land_items(feeds))
        if feeds.categories_json:
            self.step(BRONZE, "ingest_json", lambda: self.land_categories(feeds.categories_json))
        if feeds.channels_xml:
            self.step(BRONZE, "ingest_xml", lambda: self.land_channels(feeds.channels_xml))
        if feeds.channels_table is not None:
            self.step(BRONZE, "ingest_db", lambda: self.land_extract(feeds))

    def land_items(self, feeds: Feeds) -> tuple[int, str]:
        # Stored with the row: its place in the feed, which decides what a duplicate is.
        if feeds.csv_split:
            rows = read_csv_split(self.spark, feeds.items_csv, model.ITEM_FEED, place="row_seq")
        else:
            rows = read_csv_bronze(self.spark, feeds.items_csv, model.ITEM_FEED, place=True)
            rows = in_scan_order(self.wh.stage(rows, scratch_dir(self.spark, "items")), "row_seq")
        landed = with_lineage(rows, CSV_SOURCE, self.run_ts)
        n = self.wh.write_replace_partition("bronze.raw_videos", landed, self.day)
        return n, f"Ingested {n} rows from CSV"

    def land_categories(self, path: str) -> tuple[int, str]:
        rows = read_json_items(self.spark, path).withColumn(
            "row_seq", F.monotonically_increasing_id()
        )
        rows = with_lineage(rows, JSON_SOURCE, self.run_ts)
        n = self.wh.write_full("bronze.raw_categories", rows)
        return n, f"Ingested {n} rows from JSON"

    def land_channels(self, path: str) -> tuple[int, str]:
        rows = read_xml_bronze(self.spark, path, "channel", model.CHANNEL_FEED)
        n = self.wh.write_full(
            "bronze.raw_channels", with_lineage(rows, XML_SOURCE, self.run_ts)
        )
        return n, f"Ingested {n} rows from XML"

    def land_extract(self, feeds: Feeds) -> tuple[int, str]:
        """Append the source rows above the watermark."""
        target, source = self.wh.read("bronze.raw_channels_extra"), feeds.channels_table.select(*model.EXTRACT)
        new = read_incremental(source, target, "last_updated", keys=feeds.channels_keys)
        rows = with_lineage(all_strings(new), EXTRACT_SOURCE, self.run_ts)
        n = self.wh.write_append("bronze.raw_channels_extra", rows)
        return n, f"Ingested {n} incremental rows"

    # Silver

    def clean(self) -> None:
        self.step(SILVER, "validate_clean_videos", self.clean_items)
        self.step(SILVER, "validate_clean_categories", self.clean_categories)
        self.step(SILVER, "validate_clean_channels", self.clean_channels)

    def raw_items(self) -> DataFrame:
        return self.wh.read("bronze.raw_videos", None if self.full else {"ingestion_date": [self.day]})

    def clean_items(self) -> tuple[int, str]:
        raw = self.raw_items()
        row_id = "row_seq"
        order = list(ITEM_ORDER)
        if self.full:
            # Places repeat between days; day and place together name a row.
            row_id = "_row"
            raw = raw.withColumn(row_id, F.struct("ingestion_date", "row_seq"))
            order = ["load_timestamp", row_id]
        # The repeated keys are stored first, so that the join back is planned on their real size.
        repeated = repeated_keys(raw, silver.ITEM_KEYS, order, row_id)
        if self.across_loads:
            repeated = with_earlier(repeated, self.earlier_keys(raw), silver.ITEM_KEYS)
        repeated = self.wh.stage(repeated, scratch_dir(self.spark, "repeated-items"))
        classified = silver.classify_items(raw, order, row_id, repeated=repeated)
        return self.store(
            RAW_ITEMS,
            classified,
            silver.item_payload(),
            lambda valid: self.wh.write_replace_partition(
                "silver.videos", silver.typed_items(valid, self.run_ts), self.day
            ),
        )

    def earlier_keys(self, raw: DataFrame) -> DataFrame:
        """Keys of this load day that an earlier day holds as well, each once (V3 over all loads).

        The keys of every day are stored by the hash of their date, and a day is compared with the folders of
        its own dates only. A day that is repeated replaces its keys; later days have to be run again
        to be judged against them.
        """
        table = "silver.item_keys"
        keys = raw.select(*silver.ITEM_KEYS).dropna().distinct()
        bucket = F.pmod(F.xxhash64("trending_date"), F.lit(model.KEY_BUCKETS)).cast("int")
        self.wh.write_replace_partition(table, keys.withColumn("date_bucket", bucket), self.day)
        folders = self.wh.partitions(table)
        today = self.day.isoformat()
        own = {f["date_bucket"] for f in folders if f["load_date"] == today}
        before = {f["load_date"] for f in folders if f["load_date"] < today}
        mine = self.wh.read(table, {"load_date": [self.day]}).select(*silver.ITEM_KEYS)
        others = self.wh.read(table, {"load_date": before, "date_bucket": own}).select(*silver.ITEM_KEYS)
        return mine.join(others, list(silver.ITEM_KEYS), "left_semi")

    def clean_categories(self) -> tuple[int, str]:
        raw = self.wh.read("bronze.raw_categories")
        classified = silver.classify_categories(raw, [], "row_seq")
        columns = [c for c in raw.columns if c not in ("load_timestamp", "row_seq")]
        return self.store(
            RAW_CATEGORIES,
            classified,
            silver.raw_json(columns),
            lambda valid: self.wh.write_full(
                "silver.categories", silver.typed_categories(valid, self.run_ts)
            ),
        )

    def clean_channels(self) -> tuple[int, str]:
        newest = [F.desc(silver.parse_iso_timestamp(F.col("last_updated"))), F.desc("load_timestamp")]
        xml = self.wh.read("bronze.raw_channels")
        extract = self.wh.read("bronze.raw_channels_extra")
        classified = silver.classify_channels(
            silver.latest_channels(xml, [*newest, *total_order(xml)]),
            silver.latest_channels(extract, [*newest, *total_order(extract)]),
        )
        return self.store(
            CHANNELS,
            classified,
            silver.channel_payload(classified),
            lambda valid: self.wh.write_full(
                "silver.channels", silver.typed_channels(valid, self.run_ts)
            ),
        )

    def store(self, table: str, classified: DataFrame, payload, write_valid) -> tuple[int, str]:
        """Write valid rows and rejects of one classified frame, which is computed once."""
        frame, seen = counted(classified)
        frame = self.wh.stage(frame, scratch_dir(self.spark, "classified"))
        write_valid(frame)
        rejects = rejected_records(
            frame.where(F.col(REASON).isNotNull()), self.run_id, table, payload
        ).withColumn("rejected_at", timestamp(self.run_ts))
        self.wh.write_run("silver.rejected_records", rejects, run_id=self.run_id, table_name=table)
        valid, rejected = int(seen.get["valid"]), int(seen.get["rejected"])
        self.counts["inserted"] += valid
        self.counts["rejected"] += rejected
        return valid, f"Processed {table}. Valid: {valid}, Rejected: {rejected}"

    # Dimensions

    def historize(self) -> None:
        self.step(SCD, "check_channel_titles", self.check_titles)
        self.step(SCD, "scd1_categories", self.scd1_categories)
        self.step(SCD, "scd2_videos", self.scd2_items)
        self.step(SCD, "scd2_channels", self.scd2_channels)

    def check_titles(self) -> tuple[int, str]:
        """Stop before any dimension is written if real channels would share a title."""
        source = self.wh.read("silver.channels").select("channel_id", "channel_title")
        real = self.wh.current("gold.dim_channel").where(~is_inferred()).select(*source.columns)
        channels = source.distinct().unionByName(real.join(source, "channel_id", "left_anti"))
        return 0, f"Shared titles: {len(self.shared_titles(channels))}"

    def shared_titles(self, channels: DataFrame) -> list[str]:
        """Some titles that several channels carry; an error unless the first channel is to have the facts."""
        shared = channels.groupBy("channel_title").count().where("count > 1").limit(5).collect()
        titles = [r["channel_title"] for r in shared]
        if titles and self.on_shared_title != "first":
            raise ValueError(f"several current channels share a title, e.g. {', '.join(map(repr, titles))}")
        return titles

    def scd1_categories(self) -> tuple[int, str]:
        table, source = "gold.dim_category", self.wh.read("silver.categories")
        buckets = self.wh.buckets_of(table, source)
        n = 0
        if buckets:
            merged = scd1(self.wh.read(table, {BUCKET: buckets}), source, "category_id")
            n = self.wh.write_buckets(table, merged, buckets)
        return n, f"SCD Type 1 categories completed. Rows: {n}"

    def loaded_items(self) -> DataFrame:
        """Silver items of this run."""
        return self.wh.read("silver.videos", {"load_date": [self.day]})

    def scd2_items(self) -> tuple[int, str]:
        return self.version_step(
            "gold.dim_video",
            self.loaded_items(),
            key="video_id",
            key_column="dim_video_key",
            tracked=model.ITEM_TRACKED,
            attributes=model.ITEM_ATTRIBUTES,
            order_by=latest_item_order(),
        )

    def scd2_channels(self) -> tuple[int, str]:
        source = self.wh.read("silver.channels")
        inserted, message = self.version_step(
            "gold.dim_channel",
            source,
            key="channel_id",
            key_column="dim_channel_key",
            tracked=model.CHANNEL_TRACKED,
            attributes=model.CHANNEL_ATTRIBUTES,
            order_by=[F.desc("load_timestamp"), *total_order(source)],
        )
        return inserted, f"{message}, Replaced inferred: {self.retire_inferred()}"

    def retire_inferred(self) -> int:
        """Close inferred channels that a source has now described."""
        table = "gold.dim_channel"
        found = replaced_inferred(self.wh.current(table))
        replaced = self.wh.stage(found, scratch_dir(self.spark, "replaced"))
        n = replaced.count()
        if n:
            buckets = self.wh.buckets_of(table, replaced)
            current = self.wh.current(table, buckets)
            self.wh.write_versions(table, scd2_close(current, replaced, "channel_id", self.run_ts), buckets)
            self.counts["updated"] += n
        return n

    def version_step(
        self, table: str, source: DataFrame, *, key: str, tracked, order_by, **how
    ) -> tuple[int, str]:
        """SCD2 over the buckets that hold a new or changed key; the others are neither rewritten nor shuffled."""
        touched = scd2_touched(self.wh.current(table), source, key, tracked, order_by)
        touched = self.wh.stage(touched, scratch_dir(self.spark, "touched"))
        buckets = self.wh.buckets_of(table, touched)
        inserted = closed = 0
        if buckets:
            target = self.wh.current(table, buckets)
            # Closed rows are read only for keys without a current one.
            absent = touched.where(ABSENT)
            old = self.wh.buckets_of(table, absent)
            if old:
                closed_rows = self.wh.history(table, old)
                target = target.unionByName(closed_rows.join(absent.select(key), key, "left_semi"))
            new = source.join(touched.select(key), key, "left_semi")
            result = scd2(target, new, key=key, tracked=tracked, order_by=order_by, run_ts=self.run_ts, **how)
            now = timestamp(self.run_ts)
            # Rows closed by earlier runs are already stored.
            changed = result.where(F.col("is_current") | (F.col("effective_end_date") == now))
            rows, seen = self.observed_versions(changed)
            self.wh.write_versions(table, rows, buckets)
            inserted, closed = (int(seen.get[c]) for c in ("inserted", "closed"))
            self.counts["updated"] += closed
        return inserted, f"{table} completed. Closed: {closed}, Inserted: {inserted}"

    def observed_versions(self, rows: DataFrame):
        seen = Observation()
        started = F.col("is_current") & (F.col("effective_start_date") == timestamp(self.run_ts))
        return (
            rows.observe(
                seen,
                F.count_if(started).alias("inserted"),
                F.count_if(~F.col("is_current")).alias("closed"),
            ),
            seen,
        )

    # Gold

    def build(self) -> None:
        self.step(GOLD, "load_fact_table", self.load_fact)
        self.step(GOLD, "mart_states", self.refresh_states)
        self.step(GOLD, "channel_performance_mart", self.channel_mart)
        self.step(GOLD, "trending_kpi_summary_mart", self.kpi_mart)
        self.step(GOLD, "trending_trends_mart", self.trends_mart)

    def load_fact(self) -> tuple[int, str]:
        # Read by three searches for missing members and the star join, so it is stored once.
        items = self.wh.stage(self.items_to_reload(), scratch_dir(self.spark, "items"))
        inferred = self.add_inferred(items)
        channels = self.wh.current("gold.dim_channel")
        seen = Observation()
        facts = star_join(
            items.observe(seen, F.count(F.lit(1)).alias("n")),
            self.wh.current("gold.dim_video"),
            self.wh.read("gold.dim_category"),
            self.one_per_title(channels),
            self.run_ts,
        )
        n = self.wh.write_dates("gold.fact_video_metrics", facts, self.loaded_dates())
        dropped = int(seen.get["n"]) - n
        return n, f"Fact load complete. {inferred}, Loaded: {n}, Without member: {dropped}"

    def loaded_dates(self) -> list[str]:
        """The dates this run brought, as the folders of its load day name them."""
        folders = self.wh.partitions("silver.videos", {"load_date": [self.day]})
        return sorted({f["trending_date"] for f in folders})

    def items_to_reload(self) -> DataFrame:
        """All silver rows of the dates this run brought, each item and date from its newest load.

        A date is reloaded as a whole, so rows of earlier loads that this run did not repeat stay. Silver is laid
        out by load and date: only folders of these dates are read.
        """
        of_dates = self.wh.read("silver.videos", {"trending_date": self.loaded_dates()})
        return newest_rows(of_dates, ["video_id", "trending_date"], "load_date")

    def add_inferred(self, items: DataFrame) -> str:
        """Add members that items refer to but no source has described."""
        found = {}
        categories = self.wh.read("gold.dim_category")
        new = inferred_categories(items, categories, self.run_ts)
        found["Cat"] = self.add_rows("gold.dim_category", new)
        new = inferred_channels(items, self.wh.read("gold.dim_channel"), self.run_ts)
        found["Ch"] = self.add_rows("gold.dim_channel", new)
        new = inferred_items(
            items, self.wh.read("gold.dim_video"), latest_item_order(), self.run_ts
        )
        found["Vid"] = self.add_rows("gold.dim_video", new)
        return "Inferred " + ", ".join(f"{k}: {v}" for k, v in found.items())

    def add_rows(self, table: str, new: DataFrame) -> int:
        """Store new members beside those the dimension has; no bucket is rewritten."""
        staged = self.wh.stage(new, scratch_dir(self.spark, "members"))
        return 0 if staged.isEmpty() else self.wh.write_more(table, staged)

    def one_per_title(self, channels: DataFrame) -> DataFrame:
        """Current channels, each title once; facts of a shared title would else count twice."""
        if self.on_shared_title == "first":
            titled = channels.select("channel_title", "channel_id", "dim_channel_key", "is_current")
            return latest_per_key(titled, ["channel_title"], [F.asc("channel_id")])
        self.shared_titles(channels)
        return channels

    def mart(self, name: str, frame: DataFrame) -> tuple[int, str]:
        n = self.wh.write_full(name, marts.with_load_timestamp(frame, timestamp(self.run_ts)))
        return n, f"{name} complete. Rows: {n}"

    def refresh_states(self) -> tuple[int, str]:
        """What the marts need of the dates this run reloaded; other dates keep theirs."""
        dates = mart_states.refresh(self.wh, self.loaded_dates())
        return len(dates), f"Mart states complete. Dates: {len(dates)}"

    def channel_mart(self) -> tuple[int, str]:
        frame = mart_states.channel_performance(self.wh.read("gold.day_channels"), self.wh.read("gold.dim_channel"))
        return self.mart("gold.channel_performance_mart", frame)

    def kpi_mart(self) -> tuple[int, str]:
        totals, categories = self.wh.read("gold.day_totals"), self.wh.read("gold.day_categories")
        frame = mart_states.daily_kpi(totals, categories, self.wh.read("gold.dim_category"))
        return self.mart("gold.trending_kpi_summary_mart", frame)

    def trends_mart(self) -> tuple[int, str]:
        return self.mart("gold.trending_trends_mart", mart_states.daily_trends(self.wh.read("gold.day_totals")))


def total_order(df: DataFrame) -> list:
    """All columns, to leave no ties between different rows."""
    return [F.desc(c) for c in df.columns]


def latest_item_order() -> list:
    """Newest load first, then newest date, then all attributes."""
    return [
        F.desc("load_timestamp"),
        F.desc("trending_date"),
        *[F.desc(c) for c in model.ITEM_ATTRIBUTES],
    ]


def run_pipeline(
    spark: SparkSession,
    root: str,
    feeds: Feeds,
    run_id: str,
    run_ts: dt.datetime,
    **options: object,
) -> dict[str, int]:
    """Run all steps against the warehouse at ``root``; returns the record counts of the run."""
    return Pipeline(spark, Warehouse(spark, root), run_id, run_ts, **options).run(feeds)
