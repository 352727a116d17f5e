"""Text, number, id and JSON functions over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.bindings import fixtures as L
from shelfwright.bindings.registry import query, table
from shelfwright.functions import coerce, ids, jsontext, price, text, times
from shelfwright.operators.matching import resolve_reference
from shelfwright.operators.normalize import HINTS, normalize_listings

c = F.col
NAMES = ["products"]


def _digest(value: Column) -> list[Column]:
    return [F.sha2(value, 256).alias("digest"), F.length(value).alias("n_chars")]


@query("clean_text", f"""SELECT doc_id, sha256(t) AS digest, CAST(length(t) AS INTEGER) AS n_chars
FROM (SELECT doc_id, {L.clean_sql("replace(text, 'ß', 'ss')")} AS t FROM documents)""")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", *_digest(text.clean_text(c("text"))))


@query("collapse_ws", r"""SELECT doc_id, sha256(t) AS digest, CAST(length(t) AS INTEGER) AS n_chars
FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)""")
def collapse_ws(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", *_digest(text.collapse_ws(c("text"))))


@query("first_line", r"""SELECT conv_id, turn, sha256(t) AS digest, CAST(length(t) AS INTEGER) AS n_chars
FROM (SELECT conv_id, turn, regexp_extract(regexp_replace(text, '^\s+|\s+$', '', 'g'), '^[^\r\n]*') AS t FROM conversations)""")
def first_line(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", *_digest(text.first_line(c("text"))))


@query("earliest_keyword", r"""SELECT doc_id, CASE
    WHEN w IN ('the', 'and', 'of') THEN 'english' WHEN w IN ('der', 'und', 'sch') THEN 'german'
    WHEN w IN ('le', 'de', 'que') THEN 'romance' END AS label
FROM (SELECT doc_id, regexp_extract(lower(text), '(?s)^.*?(the|and|of|der|und|sch|le|de|que)', 1) AS w FROM documents)""")
def earliest_keyword(spark: SparkSession, sf: str) -> DataFrame:
    labels = [("english", "the|and|of"), ("german", "der|und|sch"), ("romance", "le|de|que")]
    return table(spark, sf, "documents").select("doc_id", text.earliest(F.lower("text"), labels).alias("label"))


@query("canonical_key", L.frames_sql(NAMES, f"""SELECT product_id, {L.key_sql('name')} AS name_key,
    {L.key_sql('model_name')} AS model_key FROM products"""))
def canonical_key(spark: SparkSession, sf: str) -> DataFrame:
    return L.products(spark, sf).select(
        "product_id", text.model_key(c("name")).alias("name_key"), text.model_key(c("model_name")).alias("model_key")
    )


@query("key_with_capacity", L.frames_sql(["evidence"], f"""SELECT product_id,
    CASE WHEN k = '' THEN NULL ELSE {L.sized_key_sql('k', 'extracted_gb')} END AS sized_key,
    {L.sized_key_sql('e', 'extracted_gb')} AS noise_key
FROM (SELECT product_id, extracted_gb, {L.key_sql('chipset_model')} AS k, {L.key_sql("'GeForce RTX'")} AS e FROM evidence)"""))
def key_with_capacity(spark: SparkSession, sf: str) -> DataFrame:
    gb = coerce.text_to_int(c("vram_gb"))
    return L.evidence(spark, sf).select(
        "product_id", text.model_key_with_capacity(c("chipset_model"), gb).alias("sized_key"),
        text.attempt_key(F.lit("GeForce RTX"), gb).alias("noise_key"),
    )


_CLEANED = f"SELECT product_id, {L.clean_sql('name')} AS nm FROM products"


@query("extract_capacity", L.frames_sql(NAMES, rf"""SELECT product_id,
    TRY_CAST(nullif(regexp_extract(nm, '\b([0-9]{{1,3}})\s*GB\b', 1), '') AS INTEGER) AS gb FROM ({_CLEANED})"""))
def extract_capacity(spark: SparkSession, sf: str) -> DataFrame:
    return L.products(spark, sf).select("product_id", text.capacity_gb(text.clean_text(c("name"))).alias("gb"))


@query("extract_enum_token", L.frames_sql(NAMES, rf"""SELECT product_id,
    nullif(regexp_extract(nm, '\b(GDDR6X|GDDR7|GDDR6)\b', 1), '') AS memory FROM ({_CLEANED})"""))
def extract_enum_token(spark: SparkSession, sf: str) -> DataFrame:
    return L.products(spark, sf).select("product_id", text.memory_type(text.clean_text(c("name"))).alias("memory"))


@query("sum_regex_matches", L.frames_sql(NAMES, r"""SELECT product_id,
    nullif(CAST(coalesce(list_sum(list_transform(regexp_extract_all(nm, '\b([0-9]+)\s*X\s*HDMI\b', 1), lambda x: CAST(x AS BIGINT))), 0) AS BIGINT), 0) AS hdmi,
    nullif(CAST(coalesce(list_sum(list_transform(regexp_extract_all(nm, '\b([0-9]+)\s*X\s*(DP|DISPLAYPORT|DISPLAY\s*PORT)\b', 1), lambda x: CAST(x AS BIGINT))), 0) AS BIGINT), 0) AS displayport
FROM (""" + f"SELECT product_id, {L.clean_sql('name')} || ' 1X DISPLAY PORT' AS nm FROM products)"))
def sum_regex_matches(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(text.clean_text(c("name")), F.lit(" 1X DISPLAY PORT"))
    return L.products(spark, sf).select(
        "product_id", text.port_count(name, "hdmi").alias("hdmi"), text.port_count(name, "displayport").alias("displayport")
    )


_HINTED = f"({L.normalize_sql('products')})"


@query("parse_model", L.frames_sql(NAMES, f"""SELECT product_id, model_vendor AS vendor, series_hint AS series,
    model_name_hint AS model, number FROM {_HINTED}"""))
def parse_model(spark: SparkSession, sf: str) -> DataFrame:
    model = c("m")
    parsed = L.products(spark, sf).select("product_id", text.parse_model(text.clean_text(c("name"))).alias("m"))
    return parsed.select("product_id", model["vendor"].alias("vendor"), model["series"].alias("series"),
                         model["model"].alias("model"), model["number"].alias("number"))


@query("earliest_alias", L.frames_sql(NAMES, f"""SELECT product_id, brand_hint AS brand_name,
    nullif(alias, '') AS alias FROM {_HINTED}"""))
def earliest_alias(spark: SparkSession, sf: str) -> DataFrame:
    head = text.clean_text(F.substring_index("name", ",", 1))
    found = L.products(spark, sf).select("product_id", text.brand_alias(head).alias("alias"))
    return found.select("product_id", text.brand(c("alias")).alias("brand_name"), "alias")


@query("token_filter_suffix", L.frames_sql(NAMES, f"SELECT product_id, suffix_hint FROM {_HINTED}"))
def token_filter_suffix(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_listings(L.products(spark, sf), "name").select("product_id", "suffix_hint")


@query("normalize_listings", L.frames_sql(["listings"] + NAMES, f"""SELECT l.ref, {', '.join('h.' + x for x in HINTS)}
FROM listings l JOIN {_HINTED} h ON l.product_id = h.product_id"""))
def normalize(spark: SparkSession, sf: str) -> DataFrame:
    # Names repeat per listing: hints are worked out once per product.
    hints = normalize_listings(L.products(spark, sf).select("product_id", "name"), "name")
    return L.listings(spark, sf).select("ref", "product_id").join(hints, "product_id").select("ref", *HINTS)


@query("derive_chipset", L.frames_sql(NAMES, r"""SELECT product_id,
    CASE WHEN contains(u, 'RTX') OR contains(u, 'GEFORCE') THEN 'NVIDIA' WHEN contains(u, 'RADEON') OR contains(u, 'RX') THEN 'AMD' END AS manufacturer,
    nullif(CASE WHEN starts_with(m, 'GEFORCE') THEN 'Geforce Rtx ' || m[13:16] WHEN starts_with(m, 'RADEON') THEN 'Radeon Rx ' || m[11:14] ELSE '' END
      || CASE WHEN starts_with(m, 'GEFORCE') THEN replace(replace(m[17:], 'TI', 'Ti'), 'T', 'T') WHEN m <> '' THEN replace(m[15:], 'XT', 'Xt') ELSE '' END, '') AS model,
    TRY_CAST(nullif(regexp_extract(u, '([0-9]{2})\s*GB', 1), '') AS INTEGER) AS vram_gb,
    contains(u, ' OC') OR contains(u, '-OC') OR contains(u, ' O.C') OR contains(u, ' OVERCLOCK') AS is_oc
FROM (SELECT product_id, upper(name) AS u,
    regexp_extract(upper(name), '(GEFORCE RTX [0-9]{4}\s?TI?|GEFORCE RTX [0-9]{4}|RADEON RX [0-9]{4}\s?XT?)', 1) AS m FROM products)"""))
def derive_chipset(spark: SparkSession, sf: str) -> DataFrame:
    derived = L.products(spark, sf).select("product_id", text.derive_chipset(c("name"), compat=True).alias("d"))
    return derived.select("product_id", "d.*")


@query("derive_suffix", L.frames_sql(NAMES, r"""SELECT product_id, CASE
    WHEN raw <> '' THEN nullif(trim(regexp_replace(raw, '(?i)GEFORCE RTX.*', '')), '')
    ELSE upper(line[1:1]) || lower(line[2:]) END AS suffix
FROM (SELECT product_id, raw, nullif(regexp_extract(upper(name), '(PRIME|STRIX|TUF|GAMING|VENTUS|SUPRIM|PULSE|NITRO\+?)', 1), '') AS line
  FROM (SELECT *, CASE product_id % 3 WHEN 0 THEN model_suffix || ' GeForce RTX 6010 Ti' WHEN 1 THEN CASE WHEN product_id % 2 = 0 THEN 'geforce rtx' ELSE '' END END AS raw FROM products))"""))
def derive_suffix(spark: SparkSession, sf: str) -> DataFrame:
    p = c("product_id")
    raw = (
        F.when(p % 3 == 0, F.concat(c("model_suffix"), F.lit(" GeForce RTX 6010 Ti")))
        .when(p % 3 == 1, F.when(p % 2 == 0, F.lit("geforce rtx")).otherwise(F.lit("")))
    )
    return L.products(spark, sf).select("product_id", text.derive_suffix(raw, c("name")).alias("suffix"))


@query("canonical_vendor", L.frames_sql(NAMES, """SELECT product_id,
    CASE WHEN upper(vendor_id) IN ('NVIDIA', 'AMD') THEN upper(vendor_id) END AS vendor FROM products"""))
def canonical_vendor(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.lower("vendor_id"), F.lit("\t"))
    return L.products(spark, sf).select("product_id", text.canonical_vendor(padded).alias("vendor"))


@query("slug_names", L.frames_sql(["evidence"], """SELECT product_id, regexp_replace(concat_ws('_',
    nullif(lower(aib_manufacturer), ''), lower(aib_model_suffix), lower(chipset_manufacturer),
    replace(replace(lower(chipset_model), 'geforce', ''), ' ', ''), extracted_gb || 'gb',
    CASE WHEN contains(aib_model_suffix, 'OC') THEN 'oc' END), '[^a-z0-9_]', '', 'g') AS slug FROM evidence"""))
def slug_names(spark: SparkSession, sf: str) -> DataFrame:
    return L.evidence(spark, sf).select("product_id", text.slug(
        c("aib_manufacturer"), c("aib_model_suffix"), c("chipset_manufacturer"), c("chipset_model"),
        coerce.text_to_int(c("vram_gb")), F.contains("aib_model_suffix", F.lit("OC")),
    ).alias("slug"))


@query("coerce_scalars", """SELECT p_partkey,
    CASE p_partkey % 7 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN p_size || '.5' WHEN 2 THEN CAST(p_size AS VARCHAR)
      WHEN 3 THEN p_size || '.5' WHEN 4 THEN NULL WHEN 5 THEN p_size || 'd' ELSE 'True' END AS as_str,
    CASE p_partkey % 7 WHEN 0 THEN p_size WHEN 1 THEN CASE WHEN p_size % 2 = 0 THEN p_size ELSE p_size + 1 END WHEN 2 THEN p_size END AS as_int,
    CASE p_partkey % 7 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN p_size + CAST(0.5 AS DOUBLE) WHEN 2 THEN CAST(p_size AS DOUBLE)
      WHEN 3 THEN p_size + CAST(0.5 AS DOUBLE) END AS as_float FROM part""")
def coerce_scalars(spark: SparkSession, sf: str) -> DataFrame:
    size, kind = c("p_size").cast("string"), c("p_partkey") % 7
    raw = (
        F.when(kind == 0, size).when(kind == 1, F.concat(size, F.lit(".5")))
        .when(kind == 2, F.concat(F.lit('"  '), size, F.lit(' "')))
        .when(kind == 3, F.concat(F.lit('"'), size, F.lit('.5"')))
        .when(kind == 4, F.lit('" \\t "')).when(kind == 5, F.concat(F.lit('"'), size, F.lit('d"')))
        .otherwise(F.lit("true"))
    )
    scalars = table(spark, sf, "part").select("p_partkey", F.parse_json(raw).alias("v"))
    return scalars.select(
        "p_partkey", coerce.to_str(c("v")).alias("as_str"), coerce.to_int(c("v")).alias("as_int"),
        coerce.to_float(c("v")).alias("as_float"),
    )


@query("null_out_of_range", """SELECT 'part' AS source, p_partkey AS id, CAST(CASE WHEN p_size BETWEEN 10 AND 40 THEN p_size END AS DOUBLE) AS value FROM part
UNION ALL SELECT 'customer', c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END FROM customer""")
def null_out_of_range(spark: SparkSession, sf: str) -> DataFrame:
    sizes = table(spark, sf, "part").select(
        F.lit("part").alias("source"), c("p_partkey").alias("id"),
        coerce.clip_range(c("p_size"), 10, 40).cast("double").alias("value"),
    )
    balances = table(spark, sf, "customer").select(
        F.lit("customer").alias("source"), c("c_custkey").alias("id"), coerce.non_negative(c("c_acctbal")).alias("value")
    )
    return sizes.unionByName(balances)


@query("null_out_of_vocab", """SELECT event_id,
    CASE WHEN event_type IN ('click', 'purchase', 'view') THEN event_type END AS event_type FROM events""")
def null_out_of_vocab(spark: SparkSession, sf: str) -> DataFrame:
    kept = coerce.in_vocab(c("event_type"), ("click", "purchase", "view"))
    return table(spark, sf, "events").select("event_id", kept.alias("event_type"))


_LINE_PARTS = ("l_orderkey", "l_linenumber", "l_returnflag", "missing", "open")


@query("stable_ids", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {L.id_sql('line', *_LINE_PARTS)} AS id
FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN ' Ab ' END AS missing, l_linestatus = 'O' AS open FROM lineitem)""")
def stable_ids(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    open_line = c("l_linestatus") == "O"
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        ids.stable_id("line", c("l_orderkey"), c("l_linenumber"), c("l_returnflag"),
                      F.when(open_line, F.lit(" Ab ")), open_line).alias("id"),
    )


@query("url_hash", "SELECT page_id, sha256(url) AS hash FROM pages")
def url_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", ids.url_hash(c("url")).alias("hash"))


_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"


@query("parse_eu_price", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cents / CAST(100 AS DOUBLE) AS de_price,
    CAST(cents AS DOUBLE) AS dots_only FROM (SELECT *, {_CENTS} AS cents FROM lineitem)""")
def parse_eu_price(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.format_number("l_extendedprice", 2)
    rendered = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.concat(F.lit("ab € "), F.translate(amount, ",.", ".,")).alias("de"), F.replace(amount, F.lit(","), F.lit("")).alias("dots"),
    )
    return rendered.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        price.parse_price(c("de")).alias("de_price"), price.parse_price(c("dots")).alias("dots_only"),
    )


@query("valid_price_filter", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
WHERE l_extendedprice > 0 AND l_extendedprice <= 50000""")
def valid_price_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").where(price.valid_price(c("l_extendedprice"), 50000)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )


@query("json_valid_split", """SELECT event_id, json_valid(t) AS valid,
    CASE WHEN json_valid(t) THEN CAST(json_extract_string(t, '$.k') AS INTEGER) END AS k
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN props[1:length(props) - 1] WHEN event_id % 10 = 5 THEN props || ' tail' ELSE props END AS t FROM events)""")
def json_valid_split(spark: SparkSession, sf: str) -> DataFrame:
    e, props = c("event_id"), c("props")
    cut = (
        F.when(e % 10 == 0, F.substring(props, F.lit(1), F.length(props) - 1))
        .when(e % 10 == 5, F.concat(props, F.lit(" tail"))).otherwise(props)
    )
    parsed = table(spark, sf, "events").select("event_id", jsontext.parse_strict(cut).alias("v"))
    return parsed.select("event_id", c("v").isNotNull().alias("valid"), F.try_variant_get("v", "$.k", "int").alias("k"))


@query("repair_json", """SELECT event_id,
    CASE WHEN event_id % 4 < 3 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
    CASE event_id % 4 WHEN 0 THEN 'direct' WHEN 1 THEN 'fenced' WHEN 2 THEN 'braces' ELSE 'error' END AS stage FROM events""")
def repair_json(spark: SparkSession, sf: str) -> DataFrame:
    kind, props = c("event_id") % 4, c("props")
    raw = (
        F.when(kind == 0, F.concat(F.lit("\n "), props, F.lit(" ")))
        .when(kind == 1, F.concat(F.lit("Sure:\n```json\n"), props, F.lit("\n```\nDone {ok}.")))
        .when(kind == 2, F.concat(F.lit("The answer is "), props, F.lit(" as asked.")))
        .otherwise(F.substring(props, F.lit(1), F.length(props) - 1))
    )
    fixed = table(spark, sf, "events").select("event_id", jsontext.repair_json(raw).alias("r"))
    return fixed.select("event_id", F.try_variant_get("r.value", "$.k", "int").alias("k"), c("r.stage").alias("stage"))


@query("reference_resolve", """SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 OR c_custkey % 17 = 0 THEN NULL ELSE n_name END AS resolved,
    CASE WHEN c_custkey % 13 = 0 THEN 'missing' WHEN c_custkey % 17 = 0 THEN 'unknown' END AS resolved_error
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def reference_resolve(spark: SparkSession, sf: str) -> DataFrame:
    key = c("c_custkey")
    nation = table(spark, sf, "nation")
    noisy = table(spark, sf, "customer").join(nation, c("c_nationkey") == c("n_nationkey")).select(
        "c_custkey",
        F.when(key % 13 == 0, F.lit(None)).when(key % 17 == 0, F.lit("Atlantis"))
        .otherwise(F.concat(F.lit(" "), F.lower(F.replace("n_name", F.lit("_"), F.lit(" - "))), F.lit("!"))).alias("said"),
    )
    return resolve_reference(noisy, "said", nation, "n_name").select("c_custkey", "resolved", "resolved_error")


@query("case_labels", """SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN 'CUDA Cores' WHEN 'ECONOMY' THEN 'Stream Processors' WHEN 'PROMO' THEN 'Xe Cores' ELSE p_type END AS core_label,
    CASE WHEN p_type = 'ECONOMY' THEN 'Game Clock' ELSE 'Base Clock' END AS clock_label,
    CASE WHEN p_type = 'STANDARD' THEN p_brand END AS vendor_only FROM part""")
def case_labels(spark: SparkSession, sf: str) -> DataFrame:
    kind = c("p_type")
    label = F.when(kind == "STANDARD", F.lit("CUDA Cores")).when(kind == "ECONOMY", F.lit("Stream Processors"))
    return table(spark, sf, "part").select(
        "p_partkey", label.when(kind == "PROMO", F.lit("Xe Cores")).otherwise(kind).alias("core_label"),
        F.when(kind == "ECONOMY", F.lit("Game Clock")).otherwise(F.lit("Base Clock")).alias("clock_label"),
        F.when(kind == "STANDARD", c("p_brand")).alias("vendor_only"),
    )


@query("ratio_metrics", """SELECT p_partkey, p_retailprice / nullif(p_size, 0) AS price_per_size,
    p_retailprice / nullif(p_partkey % 7, 0) AS price_per_zero FROM part""")
def ratio_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", price.ratio(c("p_retailprice"), c("p_size")).alias("price_per_size"),
        price.ratio(c("p_retailprice"), c("p_partkey") % 7).alias("price_per_zero"),
    )


@query("entity_label", L.frames_sql(NAMES, """SELECT product_id, CASE WHEN product_id % 5 = 0 THEN CAST(product_id AS VARCHAR)
    WHEN product_id % 3 = 0 THEN vendor_id || ' ' || model_name ELSE vendor_id || ' ' || model_name || ' (' || capacity_gb || 'GB)' END AS label FROM products"""))
def entity_label(spark: SparkSession, sf: str) -> DataFrame:
    p = c("product_id")
    known = p % 5 != 0
    return L.products(spark, sf).select("product_id", text.entity_label(
        p, F.when(known, c("vendor_id")), F.when(known, c("model_name")),
        F.when(p % 3 == 0, F.when(p % 2 == 0, 0)).otherwise(c("capacity_gb")),
    ).alias("label"))


@query("iso_timestamps", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y-%m-%dT%H-%M-%SZ') AS run,
    CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds, CAST(NULL AS BIGINT) AS bad FROM events""")
def iso_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    written = table(spark, sf, "events").select(
        "event_id", times.iso_text(c("ts")).alias("iso"), times.run_text(c("ts")).alias("run")
    )
    return written.withColumns({
        "seconds": F.unix_seconds(times.parse_iso(c("iso"))), "bad": F.unix_seconds(times.parse_iso(c("run")))
    })
