"""Readers for listing pages, evidence, index and seed documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwright import schemas
from shelfwright.functions.coerce import to_float, to_int, to_str
from shelfwright.functions.ids import stable_id
from shelfwright.functions.jsontext import parse_strict
from shelfwright.functions.text import has_text
from shelfwright.operators.latest import first_rows
from shelfwright.operators.matching import resolve_reference
from shelfwright.operators.merge import RejectedLoad
from shelfwright.operators.quality import conflicting, missing_fields
from shelfwright.session import spread, written
from shelfwright.sources import files as files_

LISTING_GLOB = "page_pg=*.products.json"
#: Files that a limited scan counts first.
FIRST_FILES = 64


def _relative(root: str | None, full: str = "_metadata.file_path") -> Column:
    """Path below ``root``, or the whole path; a file that is not below it has none."""
    # The reader percent-encodes paths; a plus sign stands for itself.
    path = F.url_decode(F.replace(F.col(full), F.lit("+"), F.lit("%2B")))
    if root is None:
        return path
    below = f"{root.rstrip('/')}/"
    if ":" in root.split("/", 1)[0]:
        return F.when(path.startswith(below), F.substring(path, len(below) + 1, F.length(path)))
    at = F.instr(path, below)
    return F.when(at > 0, F.substring(path, at + len(below), F.length(path)))


def parse_array_pages(pages: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Records of pages that hold one JSON array each.

    Adds ``pos`` and ``record`` to the other columns of ``pages``. Positions are
    counted after elements that are no objects are dropped. A page that is no
    array yields one row without position and record, so it can be counted as
    an error.
    """
    items = F.try_variant_get(F.try_parse_json(F.col(text)), "$", "array<variant>")
    objects = F.filter(items, lambda v: F.schema_of_variant(v).startswith("OBJECT"))
    listed = pages.withColumn("_objects", objects).withColumn("readable", F.col("_objects").isNotNull())
    keep = [c for c in pages.columns if c != text]
    exploded = listed.select(*keep, "readable", F.posexplode_outer("_objects").alias("pos", "_item"))
    def value(field: T.StructField) -> Column:
        kind = field.dataType.simpleString()
        if kind in ("double", "int", "bigint"):  # by the JSON type: neither true nor "5d" is a number
            raw = F.try_variant_get("_item", f"$.{field.name}", "variant")
            return (to_float(raw) if kind == "double" else to_int(raw, kind)).alias(field.name)
        return F.try_variant_get("_item", f"$.{field.name}", kind).alias(field.name)

    fields = [value(f) for f in schema.fields]
    record = F.when(F.col("_item").isNotNull(), F.struct(*fields))
    return exploded.withColumn("record", record).drop("_item").where(
        ~F.col("readable") | F.col("pos").isNotNull()
    )


def _array_files(reader, path: str, glob: str, root: str | None, within: str) -> DataFrame:
    """``file, value, _path`` of whole array files; a file that is not below ``root`` has its full path and no value."""
    files = reader.option("recursiveFileLookup", True).option("pathGlobFilter", files_.glob_of(glob)).text(path, wholetext=True)
    return _placed(files.select(files_.named("_metadata.file_path"), "value"), root, within)


def _placed(files: DataFrame, root: str | None, within: str) -> DataFrame:
    below = _relative(root, "_path")
    return files.where(F.contains("_path", F.lit(within))).select(
        F.coalesce(below, F.col("_path")).alias("file"), F.when(below.isNotNull(), F.col("value")).alias("value"), "_path")


def _records(files: DataFrame, schema: T.StructType) -> DataFrame:
    rows = parse_array_pages(files.select("file", "value"), "value", schema)
    return rows.withColumn("ref", F.when(F.col("pos").isNotNull(), F.concat("file", F.lit("#"), F.col("pos"))))


def read_array_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.LISTING,
    glob: str = LISTING_GLOB,
    root: str | None = None,
    limit: int | None = None,
    within: str = "",
    by_tasks: bool = False,
) -> DataFrame:
    """All records of array files below ``path`` with file, position and reference.

    ``ref`` is ``<path below root>#<pos>``. ``limit`` keeps the first records by file
    and position; files that are unreadable or not below ``root`` come through as rows
    with ``readable`` false, do not count, and end where the last kept record's file
    ends. ``within`` is a part that paths must have. One file is one row: array files
    are pages of listings, which are small, and must fit a task. With ``by_tasks`` and
    no limit, tasks list and open the files (``files``), for folders of very many; else
    the driver lists them. Only with ``by_tasks`` files in archives are read too.
    """
    top = files_.folder(spark, path, glob) if by_tasks and limit is None else None
    if top is not None:
        names = files_.paths(spark, top, glob).where(F.contains("_path", F.lit(within)) | files_.archived())
        return _records(_placed(files_.contents(names, glob), root, within), schema)
    files = _array_files(spark.read, path, glob, root, within)
    packed = _placed(files_.unpacked(spark, path, glob), root, within) if by_tasks else None
    files = files if packed is None else files.union(packed)
    if limit is None:
        return _records(files, schema)
    paths = _paths(spark, path, glob, root, within)
    return _first_records(spark, files, paths if packed is None else paths.union(packed.select("file", "_path")), schema, limit)


def _paths(spark: SparkSession, path: str, glob: str, root: str | None, within: str) -> DataFrame:
    """``file, _path`` of the same files; their content is not read."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", files_.glob_of(glob)).load(path)
    full = names.select(files_.named("_metadata.file_path")).where(F.contains("_path", F.lit(within)))
    return full.select(F.coalesce(_relative(root, "_path"), F.col("_path")).alias("file"), "_path")


def _first_records(spark: SparkSession, files: DataFrame, paths: DataFrame, schema: T.StructType, limit: int) -> DataFrame:
    """The first ``limit`` records by file and position, by prefix sums over the files' record counts.

    The first files in path order are read and counted, four times as many each time until they hold enough. Files beyond
    are neither read nor parsed. A record is kept if the records before its file and its position say so: nothing is sorted.
    """
    first = FIRST_FILES
    while True:
        head = first_rows(paths, ["file"], first)
        end = head.agg(F.max("file").alias("file"), F.max("_path").alias("path"), F.count("*").alias("n")).first()
        if end["n"] == 0:
            return _records(files, schema).limit(0)
        # The bound on the raw path is a condition on the file itself, so the scan leaves out what lies beyond.
        near = files.where((F.col("_path") <= end["path"]) & (F.col("file") <= end["file"]))
        counts = written(spark, _records(near, schema).groupBy("file").agg(F.count("pos").alias("n")), "file-counts")
        if end["n"] < first or (counts.agg(F.sum("n")).first()[0] or 0) >= limit:
            break
        first *= 4
    before = F.sum("n").over(Window.orderBy("file")) - F.col("n")  # a row per file of the head
    sums = counts.select("file", before.alias("_before")).where(F.col("_before") < limit)
    rows = _records(near, schema).join(sums, "file")
    return rows.where(~F.col("readable") | (F.col("_before") + F.col("pos") < limit)).drop("_before")


def _texts(spark: SparkSession, path: str, root: str | None, name: str, limit: int | None = None) -> DataFrame:
    """Path below ``root`` as column ``name``, and ``value``, of all ``*.json`` files below ``path``, or the first ``limit``: one row each."""
    top = files_.folder(spark, path, "*.json")
    placed = lambda rows: rows.withColumn(name, _relative(root, "_path"))
    if top is None:
        files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", files_.glob_of("*.json")).text(path, wholetext=True)
        rows = files.select(files_.named("_metadata.file_path"), "value").union(files_.unpacked(spark, path, "*.json"))
    else:
        names = files_.paths(spark, top, "*.json")
        if limit is not None:  # what an archive holds is known when it is read
            plain = names.where(~files_.archived()).select("_path", files_.named("_path").alias("_name"))
            loose = first_rows(plain.withColumn(name, _relative(root, "_name")), [name], limit)
            names = loose.select("_path").union(names.where(files_.archived()))
        rows = files_.contents(names, "*.json")
    return first_rows(placed(rows).select(name, "value"), [name], limit)


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.EVIDENCE,
    limit: int | None = None,
    root: str | None = None,
    prefer: str | None = None,
) -> DataFrame:
    """Documents of one JSON object per file: ``path``, fields and ``readable``.

    ``prefer`` names a source sub-directory that is read alone when it exists.
    ``limit`` keeps the first files in path order.
    """
    if prefer:
        preferred = f"{path.rstrip('/')}/{prefer}"
        path = preferred if _exists(spark, preferred) else path
    # Cut by path first: only what is kept gets parsed.
    files = _texts(spark, path, root, "path", limit).select("path", "value", parse_strict(F.col("value")).alias("_v"))
    readable = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    parsed = files.select("path", F.from_json("value", schema).alias("_doc"), readable.alias("readable"))
    return parsed.select("path", "_doc.*", "readable")


def _exists(spark: SparkSession, path: str) -> bool:
    if files_.folder(spark, path, "*.json") is not None:
        return True
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").schema
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_listings(
    spark: SparkSession, path: str, root: str | None = None, limit: int | None = None, glob: str = LISTING_GLOB, within: str = "/runs/",
) -> DataFrame:
    """Listings of run pages as the silver load takes them: flat, with ``observed_at``, ``run_id``, file, position and reference.

    Unreadable pages are rows with ``readable`` false and no other value.
    """
    return _flat(read_array_files(spark, path, schemas.LISTING, glob, root, limit, within, by_tasks=True))


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select("file", "pos", "ref", "readable", "record.*").withColumnsRenamed(
        {"observed_at_utc": "observed_at", "scrape_run_id": "run_id"})


def stream_listings(
    spark: SparkSession, path: str, root: str | None = None, glob: str = LISTING_GLOB, within: str = "/runs/", files: int | None = None,
) -> DataFrame:
    """The columns of ``read_listings`` as a stream over newly arrived pages, at most ``files`` of them in a batch."""
    reader = spark.readStream if files is None else spark.readStream.option("maxFilesPerTrigger", files)
    return _flat(_records(_array_files(reader, path, glob, root, within), schemas.LISTING))


def read_index(spark: SparkSession, path: str, root: str | None = None, keep_unreadable: bool = False) -> DataFrame:
    """Index documents with their ``url_hash``, which is the file's name; a file that is no object is left out.

    With ``keep_unreadable`` such a file is a row with ``readable`` false, which the lookups leave out and the load counts.
    ``hypotheses`` and ``observation_refs`` keep the texts that are not blank; a value that is no list is none.
    """
    files = (
        _texts(spark, path, root, "index_path").select("index_path", parse_strict(F.col("value")).alias("_v"))
        .withColumn("readable", F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)))
    )

    def texts(name: str) -> Column:
        items = F.try_variant_get("_v", f"$.{name}", "array<variant>")
        return F.coalesce(F.filter(F.transform(items, to_str), has_text), F.array().cast("array<string>"))

    own = [F.try_variant_get("_v", f"$.{n}", "string").alias(n) for n in ("normalized_name", "product_url", "retailer", "first_seen_at")]
    return files.where(F.lit(keep_unreadable) | F.col("readable")).select(
        F.regexp_extract("index_path", r"([^/]*)\.json$", 1).alias("url_hash"), *own, "index_path",
        texts("hypotheses").alias("hypotheses"), texts("marketplace_observations").alias("observation_refs"), "readable")


def split_permissive(df: DataFrame, corrupt: str = "_corrupt") -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows of a permissive JSON read."""
    bad = F.col(corrupt).isNotNull()
    return df.where(~bad).drop(corrupt), df.where(bad)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines; text that does not parse is kept in ``_corrupt``."""
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    lines = spark.read.text(path).where(has_text(F.col("value")))
    return lines.select(F.from_json("value", with_bad, options).alias("_row")).select("_row.*")


def explode_index(df: DataFrame, refs_col: str) -> DataFrame:
    """One row per reference of an index document; blank references are dropped."""
    refs = F.filter(F.col(refs_col), has_text)
    return df.withColumn("ref", F.explode(refs)).drop(refs_col)


def _lacking() -> Column:
    """Sections and fields that ``entry`` lacks."""
    checks = []
    for section, names in schemas.SEED_FIELDS.items():
        body = F.get_json_object("entry", f"$.{section}")
        checks.append(F.coalesce(
            missing_fields(body, names), F.array(F.lit(f"section {section}"))
        ))
    return F.concat(*checks)


def seed_problems(entries: DataFrame) -> DataFrame:
    """Entries (``file, pos, entry`` with JSON text) that lack a section or field."""
    return entries.withColumn("problems", _lacking()).where(F.size("problems") > 0)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Seed entries ``file, pos, entry`` of all ``*.json`` arrays in ``path``.

    Missing files, a root that is no array and elements that are no objects
    are errors, because a seed load is all or nothing.
    """
    files = (
        spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )
    items = F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>")
    parsed = files.withColumn("_items", items)
    if parsed.isEmpty():
        raise FileNotFoundError(f"no seed files in {path}")
    rows = parsed.select("file", F.posexplode_outer("_items").alias("pos", "_item"))
    entry = F.when(F.schema_of_variant("_item").startswith("OBJECT"), F.to_json("_item"))
    rows = rows.select("file", "pos", entry.alias("entry"))
    bad = rows.where("entry is null").limit(5).collect()
    if bad:
        raise RejectedLoad(f"not an array of objects: {[(r.file, r.pos) for r in bad]}")
    return rows


def seed_relations(
    entries: DataFrame, vendors: DataFrame, architectures: DataFrame, memory_types: DataFrame
) -> dict[str, DataFrame]:
    """``chip``, ``memory``, ``features`` and ``problems`` of seed entries.

    References resolve by their comparable form. The chip id is made of all chip
    and memory fields, so identical entries fall together and an id with two
    feature sets is a problem; so is a value that does not fit its column's type.
    """
    parsed = spread(entries).withColumn("_v", F.parse_json("entry"))
    field = lambda section, name, kind="variant": F.try_variant_get("_v", f"$.{section}.{name}", kind)
    parts = [
        to_str(field(section, name))
        for section in ("chip", "memory") for name in schemas.SEED_FIELDS[section]
    ]
    df = parsed.withColumns({
        "chip_id": stable_id("chip", *parts, stripped=True),
        "_vendor": field("chip", "vendor", "string"),
        "_arch": field("chip", "architecture", "string"),
        "_mem": field("memory", "memory_type", "string"),
    })
    df = resolve_reference(df, "_vendor", vendors, "vendor_id", "vendor_id")
    df = resolve_reference(df, "_arch", architectures.select("architecture_id"), "architecture_id", "architecture_id")
    df = resolve_reference(df, "_mem", memory_types.select("memory_type_id"), "memory_type_id", "memory_type_id")
    text_fields = {"brand_series", "model_name", "code_name", "compute_units_type", "pcie_generation"}
    labels = {"raytracing_api_support", "cuda_compute_capability", "dlss_version", "nvenc_generation"}
    references = {"vendor", "architecture", "memory_type"}
    kinds = {n: "string" for n in text_fields | labels | references} | {"launch_date": "date", "memory_speed_gbps": "double", "memory_bandwidth_gbs": "double"}
    kinds |= {n: "boolean" for n in schemas.SEED_FIELDS["features"] if n not in labels}
    typed = lambda section, name: field(section, name, kinds.get(name, "int"))
    odd = F.array_compact(F.array(*[
        F.when(field(section, name).isNotNull() & ~F.coalesce(F.is_variant_null(field(section, name)), F.lit(True))
               & typed(section, name).isNull(), F.lit(f"{section}.{name}"))
        for section, names in schemas.SEED_FIELDS.items() for name in names]))
    ids = ["chip_id", "vendor_id", "architecture_id", "memory_type_id"]
    # Parsed, checked and resolved once: all frames read it.
    df = written(entries.sparkSession, df.select(
        "file", "pos", "entry", *ids, odd.alias("odd"), _lacking().alias("lacking"),
        F.coalesce("vendor_id_error", "architecture_id_error", "memory_type_id_error").isNotNull().alias("unknown"),
        *[F.struct(*[typed(s, n).alias(n) for n in names if n not in references]).alias(s) for s, names in schemas.SEED_FIELDS.items()]), "seed")
    section = lambda name: [F.col(f"{name}.{n}") for n in schemas.SEED_FIELDS[name] if n not in references]
    chip = df.select("chip_id", "vendor_id", "architecture_id", *section("chip"))
    memory = df.select("chip_id", "memory.vram_gb", "memory_type_id", *section("memory")[1:])
    features = df.select("chip_id", *section("features"))
    problems = (
        df.where(F.size("lacking") > 0).select("file", "pos", F.array_join("lacking", ", ").alias("problem"))
        .unionByName(df.where("unknown").select("file", "pos", F.lit("unknown reference").alias("problem")))
        .unionByName(df.where(F.size("odd") > 0).select("file", "pos", F.concat(F.lit("wrong type: "), F.array_join("odd", ", ")).alias("problem")))
        .unionByName(
            conflicting(df.select("chip_id", "entry"), ["chip_id"], ["entry"])
            .select(F.col("chip_id").alias("file"), F.lit(0).alias("pos"), F.lit("conflicting payload").alias("problem"))
        )
    )
    return {
        "chip": chip.distinct(), "memory": memory.distinct(), "features": features.distinct(),
        "problems": problems,
    }


def seed_units(parts: dict[str, DataFrame]) -> DataFrame:
    """One row per chip with a struct for each of its three relations, so that an upsert changes them together."""
    def packed(name: str) -> DataFrame:
        return parts[name].select("chip_id", F.struct(*[n for n in parts[name].columns if n != "chip_id"]).alias(name))

    return packed("chip").join(packed("memory"), "chip_id").join(packed("features"), "chip_id")
