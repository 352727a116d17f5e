"""Benchmark decontamination by question templates, in DataFrame operations only.

``template`` turns a text into lower-case words in which names, numbers and units are typed placeholders, so that a question
asked with other names and values has the same template. Every capitalised word counts as a name, also at the start of a text or
sentence. Windows of ``WINDOW`` template words of all documents are hash-joined
with those of the benchmark items; a window with fewer than ``LITERAL`` words that are no placeholders does not count. Matches
of one document and item at one distance (document place minus item place) are one candidate. It needs ``MIN_WORDS`` words in
matching windows, or half the windows of a shorter item.

Then the slots are compared: within the matched stretch, each name, number or unit of the item must stand for one value of the
document throughout. ``exact``: all values equal; ``reparameterised``: consistent, with other values. A candidate with
inconsistent slots counts only if its windows without any placeholder suffice (``exact``).

What the literal floor and the placeholders hide is found as verbatim copies (``find_copies``): windows over the plain words, in any
case, joined in the same way. ``find_leaks`` returns both.

The benchmark's windows are broadcast only if their measured size is within ``BROADCAST_BYTES``; beyond that both sides shuffle.

Rows: one per contaminated document and item, with the most matching windows at one distance (``exact`` first). Null and empty texts
match nothing. Items of ``SHORT`` to ``WINDOW`` - 1 words are one window of their own length; shorter ones have no template and are
found as verbatim copies only. Rows that share a ``doc_id``
count as one document, also those without one. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.llm.frames import checked_broadcast, written

WINDOW, SHORT, LITERAL, MIN_WORDS = 8, 5, 5, 12
#: Items with fewer words count as verbatim copies only where they are a whole line.
LINE = 3
BROADCAST_BYTES = 64 << 20
#: Placeholders: characters for private use, which no text needs.
NAME, NUMBER, UNIT = "\ue001", "\ue002", "\ue003"
#: A capitalised word, or several, wherever it stands. The first word of a sentence is one as well: whether it is a name can't be told,
#: and the comparison of slots holds it to one value throughout. The repeated groups are possessive: nothing follows that could ask them to
#: give back, and the others take a level of the stack for each word or digit group, which a long run of them exhausts.
NAMES = "(^|[ \\n\\r\\t(\"])([A-Z][a-z]+(?: [A-Z][a-z]+)*+)"
NUMBERS = "([0-9]+(?:[.,][0-9]+)*+)"
UNIT_WORDS = (
    "km", "cm", "mm", "m", "kg", "mg", "g", "ml", "l", "ms", "s", "min", "h", "seconds", "second", "minutes", "minute", "hours", "hour",
    "days", "day", "weeks", "week", "months", "month", "years", "year", "miles", "mile", "meters", "meter", "feet", "inches",
    "dollars", "dollar", "euros", "euro", "cents", "percent", "usd", "eur",
)
UNITS = f"{NUMBER} +({'|'.join(UNIT_WORDS)})([^A-Za-z0-9\\x{{80}}-\\x{{10FFFF}}]|$)"
#: Everything in ASCII but letters and digits.
BREAKS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def _with_slots(text: Column) -> tuple[Column, Column, Column]:
    """Text with names, then also numbers, then also units replaced."""
    named = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), NAMES, f"$1 {NAME} ")
    numbered = F.regexp_replace(named, NUMBERS, f" {NUMBER} ")
    return named, numbered, F.regexp_replace(numbered, UNITS, f"{NUMBER} {UNIT} $2")


def template(text: Column) -> Column:
    """Template words of a text."""
    return F.array_remove(F.split(F.lower(_with_slots(text)[2]), BREAKS), "")


def _joined(left: Column, right: Column, apart: int) -> Column:
    """At each place the hash of ``left`` there and ``right`` ``apart`` places on."""
    later = F.slice(right, apart + 1, F.greatest(F.size(right) - apart, F.lit(0)))
    return F.zip_with(left, later, lambda a, b: F.xxhash64(a, b))


def _windows(words: DataFrame, keys: list[str], sizes: list[int]) -> DataFrame:
    """``keys, size, place, window``: hash of each run of words of all ``sizes``, in one scan.

    Words are hashed once; runs of two, four and eight are pairs of shorter ones, so a text takes time in proportion to its words.
    """
    frame = words.select(*keys, F.transform("words", lambda w: F.xxhash64(w)).alias("run1"))
    steps = [1 << k for k in range(max(sizes).bit_length())]
    for step in steps[1:]:
        half = F.col(f"run{step // 2}")
        frame = frame.select("*", _joined(half, half, step // 2).alias(f"run{step}"))

    def runs(size: int) -> Column:
        parts = [step for step in reversed(steps) if size & step]
        out, at = F.col(f"run{parts[0]}"), parts[0]
        for step in parts[1:]:
            out, at = _joined(out, F.col(f"run{step}"), at), at + step
        return F.slice(out, 1, F.greatest(F.size("run1") - size + 1, F.lit(0)))

    cut = frame.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("size"), runs(n).alias("runs")) for n in sizes])).alias("cut"))
    return cut.select(*keys, "cut.size", F.posexplode("cut.runs").alias("place", "window"))


def _slots(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, place, slot, value`` of each placeholder of ``rows`` (keys, text)."""
    named, numbered, _ = _with_slots(F.col("text"))
    source = F.coalesce(F.col("text").cast("string"), F.lit(""))
    values = rows.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(kind).alias("slot"), F.regexp_extract_all(of, F.lit(pattern), F.lit(group)).alias("found"))
        for kind, of, pattern, group in ((NAME, source, NAMES, 2), (NUMBER, named, NUMBERS, 1), (UNIT, numbered, UNITS, 1))
    ])).alias("s")).select(*keys, "s.slot", F.posexplode("s.found").alias("nth", "value"))
    places = rows.select(*keys, F.posexplode(template(F.col("text"))).alias("place", "slot")).where(F.col("slot").isin(NAME, NUMBER, UNIT))
    nth = F.expr(f"row_number() over (partition by {', '.join(keys)}, slot order by place) - 1")
    return places.withColumn("nth", nth).join(values, [*keys, "slot", "nth"]).select(*keys, "place", "slot", "value")


def benchmark_windows(spark: SparkSession, benchmark: DataFrame) -> DataFrame:
    """``item_id, place, window, size, windows, plain``: windows of all items; ``plain`` ones have no placeholder."""
    words = benchmark.select("item_id", template(F.col("text")).alias("words")).where(F.size("words") >= SHORT)
    parts = []
    for size in range(SHORT, WINDOW + 1):
        own = words.where(F.size("words") >= size if size == WINDOW else F.size("words") == size)
        slots = F.size(F.filter(F.slice("words", F.col("place") + 1, size), lambda w: w.isin(NAME, NUMBER, UNIT)))
        parts.append(_windows(own, ["item_id"], [size]).join(own, "item_id").select(
            "item_id", "place", "window", "size", (F.size("words") - size + 1).alias("windows"), slots.alias("slots")))
    table = parts[0]
    for part in parts[1:]:
        table = table.union(part)
    kept = table.where(F.col("size") - F.col("slots") >= LITERAL)
    return written(spark, kept.select("item_id", "place", "window", "size", "windows", (F.col("slots") == 0).alias("plain")), "benchmark")


def find_leaks(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_windows, kind`` of contaminated documents: matching templates and verbatim copies."""
    copies = find_copies(spark, documents, benchmark).withColumn("kind", F.lit("exact"))
    best = find_templates(spark, documents, benchmark).union(copies).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("n_windows", F.col("kind") == "exact", "kind")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_windows", "b.kind")


def find_templates(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_windows, kind`` of documents with an item's template and consistent slots."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null")
    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    of_items = benchmark_windows(spark, items)
    sizes = {r["size"]: r["n"] for r in of_items.groupBy("size").agg(F.count("*").alias("n")).collect()}
    words = docs.select("doc_id", template(F.col("text")).alias("words"))
    if not sizes:
        return spark.createDataFrame([], "doc_id long, item_id long, n_windows long, kind string")
    own = of_items.select("item_id", F.col("place").alias("at"), "window", "size", "windows", "plain")
    hits = _windows(words, ["doc_id"], sorted(sizes)).join(checked_broadcast(own, 64 * sum(sizes.values()), BROADCAST_BYTES), ["size", "window"])
    apart = F.col("place") - F.col("at")
    needed = F.least(F.greatest(MIN_WORDS - F.col("size") + 1, F.lit(1)), F.expr("cast(ceil(windows / 2) as int)"))
    candidates = written(spark, hits.groupBy("doc_id", "item_id", apart.alias("apart"), "size", needed.alias("needed")).agg(
        F.count_distinct("at").alias("n_windows"), F.count_distinct(F.when(F.col("plain"), F.col("at"))).alias("n_plain"),
        F.min("at").alias("low"), F.max("at").alias("high")).where(F.col("n_windows") >= F.col("needed")), "candidates")

    of_item = _slots(items.join(candidates.select("item_id").distinct(), "item_id", "left_semi"), ["item_id"])
    of_doc = _slots(docs.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi"), ["doc_id"]).withColumnRenamed("value", "here")
    key = ["doc_id", "item_id", "apart"]
    paired = candidates.join(of_item, "item_id").where("place between low and high + size - 1").select(
        *key, (F.col("place") + F.col("apart")).alias("place"), "slot", "value").join(of_doc, ["doc_id", "place", "slot"])
    checked = paired.groupBy(*key).agg(
        F.count_distinct("slot", "value").alias("n_values"), F.count_distinct("slot", "value", "here").alias("n_pairs"),
        F.bool_and(F.col("value") == F.col("here")).alias("same"))
    judged = candidates.join(checked, key, "left")
    same = F.coalesce(F.col("same"), F.lit(True)) | (F.col("n_values") < F.col("n_pairs"))
    kept = judged.where("n_values is null or n_values = n_pairs or n_plain >= needed")
    best = kept.withColumn("kind", F.when(same, "exact").otherwise("reparameterised")).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("n_windows", F.col("kind") == "exact", "apart", "kind")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_windows", "b.kind")


def find_copies(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_windows`` of documents with a verbatim copy of an item, in upper or lower case.

    Windows are over the plain lower-cased words, so every window of every item counts: also those dense in names, numbers and
    units, and items with fewer than ``SHORT`` words, which are one window. As many are needed as in ``find_leaks``. An item of fewer
    than ``LINE`` words says too little amid other text: it must be the whole of a line.

    Null and empty texts match nothing, items without an id are left out, rows that share a ``doc_id`` (or have none) are one document.
    """
    def words_of(text: Column) -> Column:
        return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), BREAKS), "")

    items = benchmark.select(F.col("item_id").cast("long"), words_of(F.col("text")).alias("words")).where("item_id is not null")
    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    length = F.size("words")
    long, short = items.where(length >= LINE), items.where((length > 0) & (length < LINE))
    cut = _windows(long, ["item_id"], list(range(LINE, WINDOW + 1))).join(long.select("item_id", length.alias("n")), "item_id")
    cut = cut.where(F.col("size") == F.least("n", F.lit(WINDOW))).select(
        "item_id", F.col("place").alias("at"), "size", "window", (F.col("n") - F.col("size") + 1).alias("windows"))
    lines = short.select("item_id", F.lit(0).alias("at"), F.lit(0).alias("size"), _whole("words").alias("window"), F.lit(1).alias("windows"))
    of_items = written(spark, cut.union(lines), "copies")
    sizes = {r["size"]: r["n"] for r in of_items.groupBy("size").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], "doc_id long, item_id long, n_windows long")
    places = None
    if max(sizes):
        places = _windows(docs.select("doc_id", words_of(F.col("text")).alias("words")), ["doc_id"], sorted(n for n in sizes if n))
    if 0 in sizes:
        line = docs.select("doc_id", F.posexplode(F.split("text", "[\\n\\r]+")).alias("place", "line")).select(
            "doc_id", F.lit(0).alias("size"), "place", words_of(F.col("line")).alias("words")).where((length > 0) & (length < LINE))
        line = line.select("doc_id", "size", "place", _whole("words").alias("window"))
        places = line if places is None else places.union(line)
    hits = places.join(checked_broadcast(of_items, 64 * sum(sizes.values()), BROADCAST_BYTES), ["size", "window"])
    needed = F.when(F.col("size") == 0, 1).otherwise(
        F.least(F.greatest(MIN_WORDS - F.col("size") + 1, F.lit(1)), F.expr("cast(ceil(windows / 2) as int)")))
    matches = hits.groupBy("doc_id", "item_id", (F.col("place") - F.col("at")).alias("apart"), needed.alias("needed")).agg(
        F.count_distinct("at").alias("n_windows")).where(F.col("n_windows") >= F.col("needed"))
    return matches.groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"))


def _whole(words: str) -> Column:
    return F.xxhash64(F.transform(words, lambda w: F.xxhash64(w)))
