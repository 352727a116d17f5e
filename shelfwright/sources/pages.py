"""Listing pages: sanity gate, block-page classes, items and run metadata."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright import schemas as S
from shelfwright.functions.price import parse_price, valid_price
from shelfwright.sources.markup import ItemRules, page_items


def sane(html: Column, n: int = S.MIN_PAGE_LENGTH) -> Column:
    """A page that is present and at least ``n`` characters long."""
    return F.coalesce(F.length(html) >= n, F.lit(False))


def block_class(
    html: Column,
    min_len: int = S.MIN_PAGE_LENGTH,
    title_words: Sequence[str] = S.BLOCK_TITLE_WORDS,
    body_words: Sequence[str] = S.BLOCK_BODY_WORDS,
    markers: Sequence[str] = S.ITEM_MARKERS,
) -> Column:
    """``blocked_title``, ``items``, ``blocked_body`` or ``clear``; the first that holds.

    The title decides before the items do; body words count only on pages
    shorter than three times ``min_len``.
    """
    def any_of(c: Column, words: Sequence[str]) -> Column:
        found = F.lit(False)
        for w in words:
            found = found | F.contains(c, F.lit(w))
        return found

    title = F.lower(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    short = F.length(html) < 3 * min_len
    return (
        F.when(any_of(title, title_words), F.lit("blocked_title"))
        .when(any_of(html, markers), F.lit("items"))
        .when(short & any_of(F.lower(html), body_words), F.lit("blocked_body"))
        .otherwise(F.lit("clear"))
    )


def is_blocked(html: Column, **options) -> Column:
    return block_class(html, **options).startswith("blocked")


def _bounded(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices with at most ``limit`` bytes in ``column``, or one row: what Python holds at once does not follow the batch size."""
    for batch in batches:
        ends = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float)))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, end - start)
            start = end


def extract_items(
    df: DataFrame, html: str, base: str, rules: ItemRules = ItemRules(), keep: Sequence[str] = ()
) -> DataFrame:
    """Items of every page: ``keep`` columns, ``position, name, url, price``.

    ``base`` is the column with the address that relative links resolve
    against. Positions also count items that are skipped. Only the search in the
    markup runs in Python, one page at a time and streamed by Arrow batches;
    prices are parsed and checked as columns.
    """
    source = df.select(*keep, F.col(html).alias("_html"), F.col(base).alias("_base"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema.fields]
    out = ", ".join([*kept, "position int", "name string", "url string", "_prices array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _bounded(batches, "_html"):
            ids, rows = [], []
            pages, addresses = batch.column("_html").to_pylist(), batch.column("_base").to_pylist()
            for i, (page, address) in enumerate(zip(pages, addresses)):
                found = list(page_items(page, address or "", rules)) if page else []
                ids.extend([i] * len(found))
                rows.extend(found)
            index = pa.array(ids, pa.int64())
            position, name, url, prices = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(index) for c in keep],
                    pa.array(position, pa.int32()), pa.array(name, pa.string()),
                    pa.array(url, pa.string()), pa.array(prices, pa.list_(pa.string())),
                ],
                names=[*keep, "position", "name", "url", "_prices"],
            )

    # The first price text that parses counts, even if it is out of range.
    parsed = F.filter(
        F.transform("_prices", lambda t: parse_price(t, rules.price_locale)), lambda p: p.isNotNull()
    )
    items = source.mapInArrow(run, out).withColumn("price", F.get(parsed, F.lit(0))).drop("_prices")
    return items.where(valid_price(F.col("price"), rules.max_price)) if rules.need_price else items


def page_metadata(pages: DataFrame, products: DataFrame, ok: Column) -> DataFrame:
    """Per page its status and product count.

    A page that answered 200 but failed the content checks has status 0.
    ``pages`` needs ``run_id, page_number, url, fetched_at, http_status``.
    """
    counts = products.groupBy("run_id", "page_number").agg(F.count("*").alias("_n"))
    status = F.when(~ok & (F.col("http_status") == 200), 0).otherwise(F.col("http_status"))
    return pages.withColumn("http_status", status).join(counts, ["run_id", "page_number"], "left").select(
        "run_id", "page_number", "url", "fetched_at", "http_status",
        F.coalesce("_n", F.lit(0).cast("bigint")).alias("product_count"),
    )


def run_metadata(pages: DataFrame, source: str, entity: str, category: str) -> DataFrame:
    """Per run its first and last fetch."""
    return pages.groupBy("run_id").agg(
        F.min("fetched_at").alias("started_at"), F.max("fetched_at").alias("finished_at")
    ).select(
        F.lit(source).alias("source"), F.lit(entity).alias("entity"), F.lit(category).alias("category"),
        F.col("run_id").alias("scrape_run_id"), "started_at", "finished_at",
    )
