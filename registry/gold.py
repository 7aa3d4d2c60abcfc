"""Dimensions, late-arriving members and the fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import feed, query
from tierline.operators.dedupe import latest_per_key
from tierline.operators.fact import reload_by_key, star_join
from tierline.operators.members import (
    inferred_categories,
    inferred_channels,
    inferred_items,
    replaced_inferred,
)
from tierline.operators.scd import (
    VERSION,
    first_versions,
    scd1,
    scd2,
    scd2_changed,
    scd2_close,
    scd2_insert,
)
from tierline.plans.listings import version_history

FIRST_RUN = "1999-01-01 00:00:00"
SECOND_RUN = "2002-01-01 00:00:00"
ATTRIBUTES = ["status", "priority", "price"]
TRACKED = ["status", "priority"]
HOW = {"key": "id", "attributes": ATTRIBUTES, "run_ts": SECOND_RUN, "key_column": "dim_key"}


@query(
    "scd1_upsert",
    """
SELECT c_custkey AS id, c_mktsegment AS label FROM customer
WHERE NOT EXISTS (SELECT 1 FROM {states} s WHERE s.id = c_custkey)
UNION ALL
SELECT id, label FROM (
  SELECT id, coalesce(status, 'open') AS label,
         row_number() OVER (PARTITION BY id ORDER BY seen DESC, seq DESC) AS place
  FROM {states} s) u
WHERE place = 1""",
)
def scd1_upsert(spark, sf_dir):
    """Market segments overwritten by the state of each customer's last order."""
    target = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("label")
    )
    source = latest_per_key(feed(spark, sf_dir, "states"), ["id"], newest()).select(
        "id", F.coalesce("status", F.lit("open")).alias("label")
    )
    return scd1(target, source, "id")


def newest() -> list:
    return [F.desc("seen"), F.desc("seq")]


def _snapshots(spark, sf_dir):
    """The dimension as of 1999 and the rows that arrived since."""
    states = feed(spark, sf_dir, "states")
    old = states.where(F.col("seen") < "1999-01-01")
    dim = first_versions(
        latest_per_key(old, ["id"], newest()).select("id", *ATTRIBUTES), "id", "dim_key", FIRST_RUN
    ).select("dim_key", "id", *ATTRIBUTES, *VERSION)
    return dim, states.where(F.col("seen") >= "1999-01-01")


def _latest(where: str) -> str:
    return f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seen DESC, seq DESC) AS place
               FROM {{states}} s WHERE {where}) l WHERE place = 1"""


_OLD = _latest("seen < DATE '1999-01-01'")
_NEW = _latest("seen >= DATE '1999-01-01'")
_CHANGED = "(o.status IS DISTINCT FROM n.status OR o.priority IS DISTINCT FROM n.priority)"
_KEPT_OR_CLOSED = f"""
SELECT md5(concat(o.id, '|1')) AS dim_key, o.id, o.status, o.priority, o.price,
       1 AS version_number, TIMESTAMP '{FIRST_RUN}' AS effective_start_date,
       CASE WHEN n.id IS NOT NULL AND {_CHANGED} THEN TIMESTAMP '{SECOND_RUN}' END
         AS effective_end_date,
       n.id IS NULL OR NOT {_CHANGED} AS is_current
FROM ({_OLD}) o LEFT JOIN ({_NEW}) n ON o.id = n.id"""
_OPENED = f"""
SELECT md5(concat(n.id, '|', CASE WHEN o.id IS NULL THEN 1 ELSE 2 END)) AS dim_key,
       n.id, n.status, n.priority, n.price,
       CAST(CASE WHEN o.id IS NULL THEN 1 ELSE 2 END AS INT) AS version_number,
       TIMESTAMP '{SECOND_RUN}' AS effective_start_date,
       CAST(NULL AS TIMESTAMP) AS effective_end_date, true AS is_current
FROM ({_NEW}) n LEFT JOIN ({_OLD}) o ON o.id = n.id WHERE o.id IS NULL OR {_CHANGED}"""


@query(
    "scd2_changed",
    f"SELECT n.id FROM ({_NEW}) n JOIN ({_OLD}) o ON o.id = n.id WHERE {_CHANGED}",
)
def changed_states(spark, sf_dir):
    dim, arrived = _snapshots(spark, sf_dir)
    return scd2_changed(dim, arrived, "id", TRACKED, newest())


@query("scd2_close", _KEPT_OR_CLOSED)
def closed_states(spark, sf_dir):
    dim, arrived = _snapshots(spark, sf_dir)
    changed = scd2_changed(dim, arrived, "id", TRACKED, newest())
    return scd2_close(dim, changed, "id", SECOND_RUN)


@query("scd2_insert", _OPENED)
def opened_states(spark, sf_dir):
    dim, arrived = _snapshots(spark, sf_dir)
    changed = scd2_changed(dim, arrived, "id", TRACKED, newest())
    closed = scd2_close(dim, changed, "id", SECOND_RUN)
    return scd2_insert(closed, arrived, order_by=newest(), **HOW)


@query("scd2_full", f"{_KEPT_OR_CLOSED} UNION ALL {_OPENED}")
def stepped_states(spark, sf_dir):
    """The whole step with one join."""
    dim, arrived = _snapshots(spark, sf_dir)
    return scd2(dim, arrived, tracked=TRACKED, order_by=newest(), **HOW)


@query("scd2_idempotent", f"{_KEPT_OR_CLOSED} UNION ALL {_OPENED}")
def repeated_states(spark, sf_dir):
    """The same rows arriving once more at a later time change nothing."""
    dim, arrived = _snapshots(spark, sf_dir)
    once = scd2(dim, arrived, tracked=TRACKED, order_by=newest(), **HOW)
    again = HOW | {"run_ts": "2003-01-01 00:00:00"}
    return scd2(once, arrived, tracked=TRACKED, order_by=newest(), **again)


# A version starts in each year whose last state differs from that of the previous present year.
_YEARLY = """
SELECT md5(concat(id, '|', version_number)) AS dim_key, id, status, priority, price,
       CAST(version_number AS INT) AS version_number,
       make_timestamp(year + 1, 1, 1, 0, 0, 0) AS effective_start_date,
       make_timestamp(next_year + 1, 1, 1, 0, 0, 0) AS effective_end_date,
       next_year IS NULL AS is_current
FROM (
  SELECT *, row_number() OVER w AS version_number, lead(year) OVER w AS next_year
  FROM (
    SELECT *, lag(year) OVER v IS NULL OR lag(status) OVER v IS DISTINCT FROM status
              OR lag(priority) OVER v IS DISTINCT FROM priority AS starts
    FROM (SELECT *, CAST(extract(year FROM seen) AS BIGINT) AS year,
                 row_number() OVER (PARTITION BY id, extract(year FROM seen)
                                    ORDER BY seen DESC, seq DESC) AS place
          FROM {states} s) y
    WHERE place = 1 WINDOW v AS (PARTITION BY id ORDER BY year)) c
  WHERE starts WINDOW w AS (PARTITION BY id ORDER BY year)) d"""


def _yearly(spark, sf_dir, ids=None):
    """The dimension after one step per calendar year of the feed; of a few members only if ``ids`` names them.

    A step keeps members apart, so a listing of some of them needs the steps of no others.
    """
    states = feed(spark, sf_dir, "states")
    if ids is not None:
        states = states.where(F.col("id").isin(*ids))

    def of_year(year):
        days = (F.lit(f"{y}-01-01").cast("date") for y in (year, year + 1))
        return states.where((F.col("seen") >= next(days)) & (F.col("seen") < next(days)))

    if (first_last := states.select(F.min(F.year("seen")), F.max(F.year("seen"))).first())[0] is None:
        first_last = (1970, 1970)
    first, last = first_last
    dim = first_versions(
        latest_per_key(of_year(first), ["id"], newest()).select(
            "id", *ATTRIBUTES
        ),
        "id",
        "dim_key",
        f"{first + 1}-01-01 00:00:00",
    ).select("dim_key", "id", *ATTRIBUTES, *VERSION)
    for year in range(first + 1, last + 1):
        how = HOW | {"run_ts": f"{year + 1}-01-01 00:00:00"}
        dim = scd2(dim, of_year(year), tracked=TRACKED, order_by=newest(), **how)
    return dim


@query("scd2_yearly_history", _YEARLY)
def yearly_states(spark, sf_dir):
    """Seven steps in a row, giving up to seven versions per customer."""
    return _yearly(spark, sf_dir)


@query(
    "version_history",
    f"""
SELECT id, status, version_number, effective_start_date, effective_end_date, is_current
FROM ({_YEARLY}) h""",
)
def listed_versions(spark, sf_dir):
    """All versions of all customers, in order."""
    return version_history(_yearly(spark, sf_dir), "id", None, "status")


LISTED = (1, 4, 7, 10, 100)


@query(
    "version_history_of_ids",
    f"""
SELECT id, status, version_number, effective_start_date, effective_end_date, is_current
FROM ({_YEARLY}) h WHERE id IN {LISTED}""",
)
def versions_of_ids(spark, sf_dir):
    """All versions of the customers in a list."""
    return version_history(_yearly(spark, sf_dir, LISTED), "id", list(LISTED), "status")


# Late-arriving members and facts

NOW = SECOND_RUN


def _channels(spark, sf_dir):
    known = feed(spark, sf_dir, "known_channels").withColumns(
        {
            "subscriber_count": F.lit(1).cast("bigint"),
            "country": F.lit("DE"),
            "total_videos": F.lit(1),
            "total_views": F.lit(1).cast("bigint"),
        }
    )
    return first_versions(known, "channel_id", "dim_channel_key", FIRST_RUN).select(
        "dim_channel_key", "channel_id", "channel_title", "subscriber_count", "country",
        "total_videos", "total_views", *VERSION,
    )


def _videos(spark, sf_dir):
    known = feed(spark, sf_dir, "known_parts")
    return first_versions(known, "video_id", "dim_video_key", FIRST_RUN).select(
        "dim_video_key", "video_id", "title", "tags", *VERSION
    )


def _categories(spark, sf_dir):
    return feed(spark, sf_dir, "known_categories").withColumn(
        "load_timestamp", F.lit(FIRST_RUN).cast("timestamp_ntz")
    )


def _item_order() -> list:
    return [F.desc("trending_date"), F.desc("title"), F.desc("tags")]


_OPEN = f"""1 AS version_number, TIMESTAMP '{NOW}' AS effective_start_date,
       CAST(NULL AS TIMESTAMP) AS effective_end_date, true AS is_current"""

_INFERRED_CHANNELS = f"""
SELECT md5(concat('inferred_', md5(channel_title), '|1')) AS dim_channel_key,
       concat('inferred_', md5(channel_title)) AS channel_id, channel_title,
       CAST(0 AS BIGINT) AS subscriber_count, 'Unknown' AS country, 0 AS total_videos,
       CAST(0 AS BIGINT) AS total_views, {_OPEN}
FROM (SELECT DISTINCT channel_title FROM {{items}} i
      WHERE channel_title NOT IN (SELECT channel_title FROM {{known_channels}} k)) m"""


@query("inferred_members", _INFERRED_CHANNELS)
def inferred_members(spark, sf_dir):
    """Suppliers that lines refer to but the channel dimension does not hold."""
    return inferred_channels(feed(spark, sf_dir, "items"), _channels(spark, sf_dir), NOW)


@query(
    "inferred_items",
    f"""
SELECT md5(concat(video_id, '|1')) AS dim_video_key, video_id, title, tags, {_OPEN}
FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY trending_date DESC, title DESC,
                                   tags DESC) AS place FROM {{items}} i) l
WHERE place = 1 AND video_id NOT IN (SELECT video_id FROM {{known_parts}} p)""",
)
def inferred_parts(spark, sf_dir):
    items = feed(spark, sf_dir, "items").select("video_id", "title", "tags", "trending_date")
    return inferred_items(items, _videos(spark, sf_dir), _item_order(), NOW)


@query(
    "inferred_categories",
    f"""
SELECT DISTINCT category_id, concat('Inferred Category ', category_id) AS category_title,
       TIMESTAMP '{NOW}' AS load_timestamp
FROM {{items}} i WHERE category_id NOT IN (SELECT category_id FROM {{known_categories}} c)""",
)
def inferred_numbers(spark, sf_dir):
    return inferred_categories(feed(spark, sf_dir, "items"), _categories(spark, sf_dir), NOW)


@query(
    "inferred_retired",
    f"""
SELECT channel_id, channel_title, effective_end_date, is_current FROM (
  SELECT channel_id, channel_title, CAST(NULL AS TIMESTAMP) AS effective_end_date,
         true AS is_current FROM {{known_channels}} k
  UNION ALL
  SELECT concat('inferred_', md5(s_name)), s_name,
         CASE WHEN s_acctbal >= 0 THEN TIMESTAMP '{NOW}' END, s_acctbal < 0 FROM supplier) r""",
)
def inferred_retired(spark, sf_dir):
    """Every supplier inferred first; those described later replace their inferred member."""
    known = _channels(spark, sf_dir)
    inferred = inferred_channels(feed(spark, sf_dir, "groups"), known.limit(0), FIRST_RUN)
    dim = known.unionByName(inferred)
    return scd2_close(dim, replaced_inferred(dim), "channel_id", NOW).select(
        "channel_id", "channel_title", "effective_end_date", "is_current"
    )


_FACT_COLUMNS = "views, likes, dislikes, comment_count"
_FACTS = f"""
SELECT i.video_id, trending_date, md5(concat(i.video_id, '|1')) AS dim_video_key,
       category_id AS dim_category_id,
       md5(concat(coalesce(k.channel_id, concat('inferred_', md5(i.channel_title))), '|1'))
         AS dim_channel_key,
       {_FACT_COLUMNS}, TIMESTAMP '{NOW}' AS load_timestamp
FROM {{items}} i LEFT JOIN {{known_channels}} k ON i.channel_title = k.channel_title"""


def _facts(spark, sf_dir):
    items = feed(spark, sf_dir, "items")
    videos, channels = _videos(spark, sf_dir), _channels(spark, sf_dir)
    categories = _categories(spark, sf_dir)
    return star_join(
        items,
        videos.unionByName(inferred_items(items, videos, _item_order(), NOW)),
        categories.unionByName(inferred_categories(items, categories, NOW)),
        channels.unionByName(inferred_channels(items, channels, NOW)),
        NOW,
    )


@query("fact_load", _FACTS)
def fact_load(spark, sf_dir):
    """All lines mapped to members, with the late-arriving members added first."""
    return _facts(spark, sf_dir)


@query(
    "fact_star_known",
    f"""
SELECT i.video_id, trending_date, md5(concat(i.video_id, '|1')) AS dim_video_key,
       i.category_id AS dim_category_id, md5(concat(k.channel_id, '|1')) AS dim_channel_key,
       {_FACT_COLUMNS}, TIMESTAMP '{NOW}' AS load_timestamp
FROM {{items}} i JOIN {{known_channels}} k ON i.channel_title = k.channel_title
JOIN {{known_categories}} c ON i.category_id = c.category_id
JOIN {{known_parts}} p ON i.video_id = p.video_id""",
)
def fact_star_known(spark, sf_dir):
    """The star join alone: lines whose part, category and supplier are all known."""
    return star_join(
        feed(spark, sf_dir, "items"),
        _videos(spark, sf_dir),
        _categories(spark, sf_dir),
        _channels(spark, sf_dir),
        NOW,
    )


@query(
    "fact_reload_dates",
    """
SELECT trending_date, video_id, dim_channel_key, dim_category_id, views, likes FROM {facts} f
WHERE trending_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
UNION ALL
SELECT CAST(o_orderdate AS DATE), o_custkey, 0, 0, CAST(round(o_totalprice * 100) AS BIGINT), 0
FROM orders WHERE o_orderstatus = 'F'""",
)
def fact_reload_dates(spark, sf_dir):
    """Facts of all order dates replaced by finished orders; a date may end up without rows."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn(
        "trending_date", F.col("o_orderdate").cast("date")
    )
    new = orders.where(F.col("o_orderstatus") == "F").select(
        "trending_date",
        F.col("o_custkey").alias("video_id"),
        F.lit(0).cast("bigint").alias("dim_channel_key"),
        F.lit(0).alias("dim_category_id"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("views"),
        F.lit(0).cast("bigint").alias("likes"),
    )
    return reload_by_key(feed(spark, sf_dir, "facts"), new, orders, "trending_date")
