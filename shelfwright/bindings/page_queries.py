"""Page jobs and streaming jobs over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.bindings.registry import query, table
from shelfwright.functions.ids import stable_id
from shelfwright.session import workspace
from shelfwright.sources import pages
from shelfwright.sources.markup import ItemRules
from shelfwright.streaming import jobs

c = F.col
NAV = ItemRules(containers=("nav li",), links=("a",), prices=(), need_price=False)


@query("page_items", r"""SELECT page_id, CAST(pos AS INTEGER) AS position, trim(replace(regexp_extract(item, '>([^<]*)</a>', 1), '&amp;', '&')) AS name,
    regexp_extract(url, '^(https?://[^/?#]+)', 1) || regexp_extract(item, 'href="([^"]*)"', 1) AS url
FROM (SELECT page_id, url, unnest(items) AS item, generate_subscripts(items, 1) AS pos
  FROM (SELECT page_id, url, regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), '<li><a href="[^"]*">[^<]*</a></li>') AS items FROM pages))""")
def page_items(spark: SparkSession, sf: str) -> DataFrame:
    items = pages.extract_items(table(spark, sf, "pages"), "html", "url", NAV, keep=["page_id"])
    return items.select("page_id", "position", "name", "url")


@query("page_sanity", "SELECT page_id, length(html) >= 2000 AS sane FROM pages")
def page_sanity(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", pages.sane(c("html"), 2000).alias("sane"))


@query("page_block_class", r"""SELECT page_id, CASE WHEN contains(title, 'que') OR contains(title, 'und') THEN 'blocked_title'
    WHEN contains(html, 'track(3') THEN 'items'
    WHEN length(html) < 6000 AND (contains(lower(html), 'the ') OR contains(lower(html), 'sch')) THEN 'blocked_body' ELSE 'clear' END AS class
FROM (SELECT *, lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM pages)""")
def page_block_class(spark: SparkSession, sf: str) -> DataFrame:
    kind = pages.block_class(c("html"), 2000, ("que", "und"), ("the ", "sch"), ("track(3",))
    return table(spark, sf, "pages").select("page_id", kind.alias("class"))


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # A stream source takes a folder or a pattern; the pattern also fits one file.
    return spark.readStream.schema(table(spark, sf, name).schema).parquet(f"{sf}/{name}.parquet*")


@query("stream_dedup", """SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Content ids of user, type and day: every id is written once."""
    rows = _stream(spark, sf, "events").select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    keyed = rows.withColumn("content_id", stable_id("evt", c("user_id"), c("event_type"), c("day")))
    base = workspace(spark, "stream-dedup")
    jobs.ingest(keyed, f"{base}/rows", f"{base}/checkpoint", "content_id", ["content_id"]).awaitTermination()
    return jobs.read_batches(spark, f"{base}/rows", keyed.schema).select("user_id", "event_type", "day")


@query("stream_latest", """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1""")
def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stream(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    base, keys = workspace(spark, "stream-latest"), ["user_id", "event_type"]
    jobs.latest(rows, f"{base}/rows", f"{base}/checkpoint", keys, "ts", ["event_id"]).awaitTermination()
    return jobs.current_state(spark, f"{base}/rows", rows.schema, keys, "ts", ["event_id"]).drop("ts")


@query("stream_new_products", """SELECT DISTINCT sha256(url) AS url_hash, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)""")
def stream_new_products(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "pages").where("page_id % 3 = 0").select(F.sha2("url", 256).alias("url_hash"))
    rows = _stream(spark, sf, "pages").select("url")
    base = workspace(spark, "stream-new-products")
    jobs.new_products(rows, f"{base}/rows", f"{base}/checkpoint", ["url"], known, "url").awaitTermination()
    return jobs.read_batches(spark, f"{base}/rows", rows.select("url", F.sha2("url", 256).alias("url_hash")).schema).select("url_hash", "url")
