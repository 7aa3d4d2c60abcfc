"""Typed silver tables and their rejects for the three entities."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions import (
    is_missing,
    parse_bool,
    parse_feed_date,
    parse_int,
    parse_iso_timestamp,
    parse_time,
    raw_json,
    strip,
    timestamp,
)
from tierline.model import ITEM_FEED
from tierline.operators.consolidate import consolidate
from tierline.operators.dedupe import flag_duplicates, latest_per_key
from tierline.operators.validate import REASON, validate

# Reasons for rejection, in the order the rules are tried.
MISSING_VIDEO_ID = "MISSING_VIDEO_ID"
MISSING_TRENDING_DATE = "MISSING_TRENDING_DATE"
DUPLICATE_ITEM = "DUPLICATE_VIDEO_ID_AND_TRENDING_DATE"
INVALID_CATEGORY = "INVALID_CATEGORY_ID_DATATYPE"
INVALID_METRICS = "INVALID_METRIC_DATATYPES"
INVALID_DATES = "INVALID_DATE_FORMATS"
INVALID_CATEGORY_ID = "INVALID_OR_MISSING_CATEGORY_ID"
MISSING_CATEGORY_TITLE = "MISSING_CATEGORY_TITLE"
DUPLICATE_CATEGORY = "DUPLICATE_CATEGORY_ID"
MISSING_CHANNEL_ID = "MISSING_CHANNEL_ID"
MISSING_CHANNEL_TITLE = "MISSING_CHANNEL_TITLE"

ITEM_KEYS = ("video_id", "trending_date")
METRICS = ("views", "likes", "dislikes", "comment_count")
FLAGS = ("comments_disabled", "ratings_disabled", "video_error_or_removed")
TEXTS = ("title", "channel_title", "tags", "description")
RAW_COLUMNS = (*ITEM_FEED, "source_system")


def classify_items(
    raw: DataFrame,
    order_by: Sequence[str],
    row_id: str,
    *,
    repeated: DataFrame | None = None,
    keep: str = "first",
) -> DataFrame:
    """Raw items with their parsed fields (``p_*``) and the reason for rejection (V1-V5).

    Duplicates are judged on the raw text of the keys and over all rows, so a rejected row can
    still make a later one a duplicate.
    """
    flagged = flag_duplicates(raw, ITEM_KEYS, order_by, row_id, repeated=repeated, keep=keep)
    parsed = flagged.withColumns(
        {f"p_{c}": parse_int(F.col(c)) for c in METRICS}
        | {
            "p_category_id": parse_int(F.col("category_id"), "int"),
            "p_publish_time": parse_time(F.col("publish_time")),
            "p_trending_date": parse_feed_date(F.col("trending_date")),
        }
    )
    bad_metric = F.lit(False)
    for c in METRICS:
        bad_metric = bad_metric | F.col(f"p_{c}").isNull()
    category_text = F.coalesce(strip(F.col("category_id")), F.lit(""))
    rules = [
        (is_missing(F.col("video_id")), MISSING_VIDEO_ID),
        (is_missing(F.col("trending_date")), MISSING_TRENDING_DATE),
        (F.col("is_duplicate"), DUPLICATE_ITEM),
        (
            F.col("p_category_id").isNull(),
            F.concat(F.lit(f"{INVALID_CATEGORY}: '"), category_text, F.lit("'")),
        ),
        (bad_metric, INVALID_METRICS),
        (F.col("p_publish_time").isNull() | F.col("p_trending_date").isNull(), INVALID_DATES),
    ]
    return validate(parsed, rules)


def typed_items(classified: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """Valid items with their types; missing text is '' and missing flags are false."""
    text = {c: F.coalesce(strip(F.col(c)), F.lit("")) for c in TEXTS}
    flags = {c: F.coalesce(parse_bool(F.col(c)), F.lit(False)) for c in FLAGS}
    return classified.where(F.col(REASON).isNull()).select(
        strip(F.col("video_id")).alias("video_id"),
        F.col("p_trending_date").alias("trending_date"),
        text["title"].alias("title"),
        text["channel_title"].alias("channel_title"),
        F.col("p_category_id").alias("category_id"),
        F.col("p_publish_time").alias("publish_time"),
        text["tags"].alias("tags"),
        *[F.col(f"p_{c}").alias(c) for c in METRICS],
        *[flags[c].alias(c) for c in FLAGS],
        text["description"].alias("description"),
        "source_system",
        timestamp(run_ts).alias("load_timestamp"),
    )


def item_payload(columns: Sequence[str] = RAW_COLUMNS) -> Column:
    """JSON of the raw item without load columns, NULL kept (V9)."""
    return raw_json(columns)


def classify_categories(raw: DataFrame, order_by: Sequence[str], row_id: str) -> DataFrame:
    """Raw categories with their id and reason (V6); later rows of an id are rejected."""
    parsed = raw.withColumns(
        {
            "p_category_id": parse_int(F.col("category_id"), "int"),
            "p_category_title": F.coalesce(strip(F.col("category_title")), F.lit("")),
        }
    )
    # A row that fails on its own must not take the place of a good row with the same id.
    bad = F.col("p_category_id").isNull() | (F.col("p_category_title") == "")
    keyed = parsed.withColumn("_ok_id", F.when(~bad, F.col("p_category_id")))
    flagged = flag_duplicates(keyed, ["_ok_id"], order_by, row_id).drop("_ok_id")
    return validate(
        flagged,
        [
            (F.col("p_category_id").isNull(), INVALID_CATEGORY_ID),
            (F.col("p_category_title") == "", MISSING_CATEGORY_TITLE),
            (F.col("is_duplicate"), DUPLICATE_CATEGORY),
        ],
    )


def typed_categories(classified: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """Valid categories."""
    return classified.where(F.col(REASON).isNull()).select(
        F.col("p_category_id").alias("category_id"),
        F.col("p_category_title").alias("category_title"),
        "source_system",
        timestamp(run_ts).alias("load_timestamp"),
    )


def latest_channels(raw: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    """The newest row of each channel id; rows without an id all stay, to be rejected one by one."""
    missing = is_missing(F.col("channel_id"))
    named = raw.where(~missing).withColumn("_id", strip(F.col("channel_id")))
    newest = latest_per_key(named, ["_id"], order_by).drop("_id")
    return newest.unionByName(raw.where(missing))


def classify_channels(xml: DataFrame, extract: DataFrame) -> DataFrame:
    """Both channel sources merged, with title and reason.

    A title of the first source wins even when it is blank; that row is then rejected.
    """
    merged = consolidate(xml, extract, "channel_id", ("_xml", "_db"))
    title = F.coalesce(F.col("channel_title_xml"), F.col("channel_title_db"))
    titled = merged.withColumn("p_channel_title", F.coalesce(strip(title), F.lit("")))
    return validate(
        titled,
        [
            (is_missing(F.col("channel_id")), MISSING_CHANNEL_ID),
            (F.col("p_channel_title") == "", MISSING_CHANNEL_TITLE),
        ],
    )


def typed_channels(classified: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """Valid channels; metrics may be NULL and a NULL country is 'Unknown' (P3)."""
    return classified.where(F.col(REASON).isNull()).select(
        "channel_id",
        F.col("p_channel_title").alias("channel_title"),
        parse_int(F.col("subscriber_count")).alias("subscriber_count"),
        F.coalesce(strip(F.col("country")), F.lit("Unknown")).alias("country"),
        parse_int(F.col("total_videos"), "int").alias("total_videos"),
        parse_int(F.col("total_views")).alias("total_views"),
        F.lit("channels_consolidated").alias("source_system"),
        timestamp(run_ts).alias("load_timestamp"),
    )


def channel_payload(classified: DataFrame) -> Column:
    """JSON of the merged row: values that are present, all as text (V9)."""
    helpers = ("p_channel_title", REASON)
    fields = [F.col(c).cast("string").alias(c) for c in classified.columns if c not in helpers]
    return F.to_json(F.struct(*fields))
