"""Match product descriptions to canonical entities, and explain the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwright.functions import text
from shelfwright.operators.latest import top_k

def dimension_keys(dim: DataFrame, model: str = "model_name") -> DataFrame:
    """``chip_id, vendor_id, vram_gb, model_key`` of every chip with a key."""
    key = text.model_key_with_capacity(F.col(model), F.col("vram_gb"))
    return dim.select("chip_id", "vendor_id", "vram_gb", key.alias("model_key")).where(
        F.col("model_key").isNotNull() & F.col("vendor_id").isNotNull()
    )


def candidate_index(dim: DataFrame, model: str = "model_name") -> DataFrame:
    """One row per key: how many chips carry it, and the chip if only one does.

    ``vram_gb`` is NULL on the row that stands for any capacity. A key shared by
    many chips stays one row of fixed size; its members are the rows of
    ``dimension_keys`` with that key.
    """
    keyed = dimension_keys(dim, model)
    lone = F.when(F.count("*") == 1, F.min("chip_id")).alias("chip_id")
    size = F.count("*").alias("n_candidates")
    anyhow = keyed.groupBy("vendor_id", "model_key").agg(size, lone)
    exact = keyed.where("vram_gb is not null").groupBy("vendor_id", "model_key", "vram_gb").agg(size, lone)
    return anyhow.withColumn("vram_gb", F.lit(None).cast("int")).unionByName(exact)


def match_candidates(attempts: DataFrame, dim: DataFrame, keep: list[str], model: str = "model_name") -> DataFrame:
    """One row per attempt and chip with its key: ``keep``, ``chip_id``, its capacity and whether the capacity agrees.

    ``attempts`` has ``vendor_id, model_key, vram_gb`` of match attempts; one without vendor or key has no candidates. An
    attempt without capacity keeps all of them.
    """
    keyed = dimension_keys(dim, model).withColumnRenamed("vram_gb", "candidate_vram_gb")
    fits = F.col("vram_gb").isNull() | F.coalesce(F.col("vram_gb") == F.col("candidate_vram_gb"), F.lit(False))
    usable = attempts.where("vendor_id is not null and model_key is not null")
    return usable.join(keyed, ["vendor_id", "model_key"]).select(*keep, "chip_id", "candidate_vram_gb", fits.alias("kept"))


def key_samples(dim: DataFrame, n: int = 10, model: str = "model_name") -> DataFrame:
    """The first ``n`` model keys of each vendor in text order."""
    keys = dimension_keys(dim, model).select("vendor_id", "model_key").distinct()
    first = top_k(keys, ["vendor_id"], ["model_key"], n, rank="_rank", ties=False)
    return first.groupBy("vendor_id").agg(
        F.sort_array(F.collect_list("model_key")).alias("model_keys")
    )


def match_entities(
    df: DataFrame,
    index: DataFrame,
    vendor: Column,
    model: Column,
    capacity: Column,
    brand: Column | None = None,
    out: str = "match",
) -> DataFrame:
    """Add the match attempt ``out``: chip, state and the key that was used.

    ``index`` comes from ``candidate_index``. States: ``missing`` (no vendor or
    model; the brand is then dropped too), ``no_match``, ``ambiguous`` and NULL
    for a match.
    """
    v, gb = text.canonical_vendor(vendor), capacity.cast("int")
    given = v.isNotNull() & F.coalesce(model != "", F.lit(False))
    staged = df.withColumns({"_v": v, "_gb": gb, "_bare": F.when(given, text.model_key(model))})
    staged = staged.withColumn("_key", text.append_capacity(F.col("_bare"), F.col("_gb")))
    usable = F.coalesce(F.col("_key") != "", F.lit(False))
    # A vendor that no dimension has keeps unusable attempts out of the lookup; NULL would send them all to one partition.
    plain = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.NumericType))]
    spread = F.concat(F.lit("?"), F.pmod(F.xxhash64(*[F.col(f"`{n}`") for n in plain]), F.lit(4096)).cast("string"))
    staged = staged.withColumns({"_usable": usable, "_lv": F.when(usable, F.col("_v")).otherwise(spread)})
    dim = index.select(
        F.col("vendor_id").alias("_dv"), F.col("model_key").alias("_dk"), F.col("vram_gb").alias("_dgb"),
        F.col("n_candidates").alias("_n"), F.col("chip_id").alias("_chip"),
    )
    on = (F.col("_lv") == F.col("_dv")) & F.col("_key").eqNullSafe(F.col("_dk")) & F.col("_gb").eqNullSafe(F.col("_dgb"))
    found = F.coalesce(F.col("_n"), F.lit(0).cast("bigint"))
    state = (
        F.when(~F.col("_usable"), F.lit("missing"))
        .when(found == 0, F.lit("no_match"))
        .when(found > 1, F.lit("ambiguous"))
    )
    who = F.lit(None).cast("string") if brand is None else brand
    attempt = F.struct(
        F.col("_chip").alias("chip_id"), state.alias("state"), found.alias("n_candidates"),
        F.col("_v").alias("vendor_id"), F.col("_key").alias("model_key"), F.col("_gb").alias("vram_gb"),
        F.when(F.col("_usable"), who).alias("brand"),
    )
    joined = staged.join(dim, on, "left").withColumn(out, attempt)
    return joined.drop("_usable", "_v", "_gb", "_bare", "_key", "_lv", "_dv", "_dk", "_dgb", "_n", "_chip")


def pick_attempt(first: Column, second: Column) -> dict[str, Column]:
    """Columns of the winner: the first attempt if it found a chip, else the second.

    Vendor, key and capacity all come from the winner; the brand is the first
    attempt's, or else the second's.
    """
    won = first["chip_id"].isNotNull()
    fields = ("chip_id", "state", "n_candidates", "vendor_id", "model_key", "vram_gb")
    columns = {f: F.when(won, first[f]).otherwise(second[f]) for f in fields}
    columns["brand"] = F.coalesce(F.nullif(first["brand"], F.lit("")), F.nullif(second["brand"], F.lit("")))
    columns["match_source"] = F.when(won, F.lit("normalize")).otherwise(F.lit("extraction"))
    return columns


def match_two_attempts(
    df: DataFrame,
    index: DataFrame,
    first: tuple[Column, Column, Column, Column],
    second: tuple[Column, Column, Column, Column],
) -> DataFrame:
    """Add both attempts and the winner's columns.

    ``first`` and ``second`` are ``(vendor, model, capacity, brand)``; the first
    usually holds hints parsed from the raw name, the second evidence fields.
    """
    a = match_entities(df, index, *first, out="first_attempt")
    b = match_entities(a, index, *second, out="second_attempt")
    return b.withColumns(pick_attempt(F.col("first_attempt"), F.col("second_attempt")))


def explain_match(df: DataFrame, dim: DataFrame, vendor: str, key: str, capacity: str) -> DataFrame:
    """Add what the match saw: vendor known, candidates with and without capacity.

    ``candidates`` counts the chips with the key, ``filtered`` those that also
    have the capacity, ``capacities`` how many different capacities they have.
    The chips themselves are the rows of ``dimension_keys``.
    """
    keyed = dimension_keys(dim)
    per_key = keyed.groupBy(F.col("vendor_id").alias(vendor), F.col("model_key").alias(key)).agg(
        F.count("*").alias("candidates"), F.count_distinct("vram_gb").alias("capacities"),
        F.min("vram_gb").alias("min_vram_gb"), F.max("vram_gb").alias("max_vram_gb"),
    )
    per_size = keyed.where("vram_gb is not null").groupBy(
        F.col("vendor_id").alias(vendor), F.col("model_key").alias(key), F.col("vram_gb").alias(capacity)
    ).agg(F.count("*").alias("_filtered"))
    present = key_samples(dim).select(
        F.col("vendor_id").alias(vendor), F.lit(True).alias("_present"), F.col("model_keys").alias("key_sample")
    )
    zero = F.lit(0).cast("bigint")
    return (
        df.join(per_key, [vendor, key], "left")
        .join(per_size, [vendor, key, capacity], "left")
        .join(present, vendor, "left")
        .withColumns({
            "vendor_present": F.coalesce("_present", F.lit(False)),
            "candidates": F.coalesce("candidates", zero),
            "capacities": F.coalesce("capacities", zero),
            "filtered": F.when(F.col(capacity).isNull(), F.coalesce("candidates", zero))
            .otherwise(F.coalesce("_filtered", zero)),
        })
        .drop("_present", "_filtered")
    )


def resolve_reference(
    df: DataFrame, col: str, dim: DataFrame, id_col: str, out: str = "resolved"
) -> DataFrame:
    """Add the dimension id whose comparable form equals that of ``col``.

    NULL and unknown texts stay NULL in ``out``; ``<out>_error`` names why. Two
    ids with one comparable form resolve to neither.
    """
    ids = F.col(id_col)
    keys = (
        dim.where(ids.isNotNull())
        .groupBy(text.reference_key(ids.cast("string")).alias("_ref"))
        .agg(F.min(ids).alias("_lo"), F.max(ids).alias("_hi"))
    )
    joined = df.withColumn("_ref", text.reference_key(F.col(col))).join(keys, "_ref", "left")
    one = F.col("_lo") == F.col("_hi")
    return joined.withColumns({
        out: F.when(one, F.col("_lo")),
        f"{out}_error": F.when(F.col(col).isNull(), F.lit("missing"))
        .when(F.col("_lo").isNull(), F.lit("unknown"))
        .when(~one, F.lit("ambiguous")),
    }).drop("_ref", "_lo", "_hi")
