"""Folders of very many small files, listed and read by tasks: the driver holds neither their names nor their sizes.

A small file takes a whole block of a disk. Files may therefore lie in zip archives beside or instead of loose ones: a member is
read as the file of that name in the archive's folder. An archive is read by one task and ends the load when it is damaged. A
loose file may be compressed on its own: ``<name>.gz`` is read as the file ``<name>``.
"""

from __future__ import annotations

import fnmatch
import gzip
import io
import os
import re
import zipfile
from collections.abc import Iterable, Iterator
from typing import BinaryIO
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.session import spread, written

#: Rows and bytes of one batch of file contents.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20
ARCHIVES, GZIPPED = "*.zip", ".gz"
# What a URI's path does not spell out: the readers' file paths have it percent-encoded.
_OTHER = re.compile(r"[^A-Za-z0-9_\-!.~'()*:@&=+$,;/\u0080-\U0010FFFF]")


def folder(spark: SparkSession, path: str, glob: str) -> str | None:
    """The folder that tasks can list for ``path``; None where Spark's own readers have to: other stores, patterns, a single file.

    ``glob`` may have stars only, and names no compressed files.
    """
    local = path.removeprefix("file:")
    if local == path and not spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
        return None
    local = re.sub("/+", "/", local)
    plain = local.startswith("/") and "/../" not in f"{local}/" and not re.search(r"[*?\[\]{}\\]", local)
    if not plain or not re.fullmatch(r"[\w=*. -]*\.json", glob):
        return None
    return local.rstrip("/") if os.path.isdir(local) else None


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out."""
    return name.startswith(".") or name.endswith("._COPYING_") or (
        name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata")))


def _quoted(path: str) -> str:
    return _OTHER.sub(lambda c: f"%{ord(c[0]):02X}", path)


def _uri(path: str) -> str:
    return "file:" + _quoted(path)


def glob_of(glob: str) -> str:
    """``glob`` for Spark's readers, with the compressed files; they decompress these by their ending."""
    return glob if re.search(r"[,{}\\]", glob) else f"{{{glob},{glob}{GZIPPED}}}"


def named(path: str) -> Column:
    """The path of a file, compressed or not, as ``_path``."""
    return F.regexp_replace(path, rf"\{GZIPPED}$", "").alias("_path")


def archived() -> Column:
    """Whether ``_path`` is an archive."""
    return F.endswith(F.col("_path"), F.lit(ARCHIVES[1:]))


def _listing(glob: str):
    def entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, rows = re.compile("|".join(map(fnmatch.translate, (glob, f"{glob}{GZIPPED}", ARCHIVES)))), []
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with os.scandir(unquote(uri.removeprefix("file:")) or "/") as found:
                    for entry in found:
                        below = entry.is_dir()
                        if not _hidden(entry.name) and (below or wanted.match(entry.name)):
                            rows.append((_uri(entry.path), below))
                        if len(rows) == 10 * BATCH_ROWS:
                            yield _batch(rows, ("_path", pa.string()), ("below", pa.bool_()))
                            rows = []
        yield _batch(rows, ("_path", pa.string()), ("below", pa.bool_()))

    return entries


def _batch(rows: list[tuple], *columns: tuple[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(columns)], [name for name, _ in columns])


def paths(spark: SparkSession, top: str, glob: str) -> DataFrame:
    """``_path`` of the files, compressed or not, and archives below the folder ``top``, as Spark's readers spell it; listed once, level by level, a folder by one task."""
    level, found = spark.createDataFrame([(_uri(top),)], "_path string").coalesce(1), None
    while True:
        seen = written(spark, level.mapInArrow(_listing(glob), "_path string, below boolean"), "listed")
        files = seen.where("not below").select("_path")
        found = files if found is None else found.union(files)
        folders = seen.where("below").select("_path")
        if folders.isEmpty():
            return found
        level = spread(folders)


def _members(uri: str, archive: BinaryIO, wanted: re.Pattern) -> Iterator[tuple[str, bytes]]:
    with zipfile.ZipFile(archive) as packed:
        for member in packed.infolist():
            names = member.filename.split("/")
            if wanted.match(names[-1]) and not any(map(_hidden, names)):
                yield f"{uri.rsplit('/', 1)[0]}/{_quoted(member.filename)}", packed.read(member)


def _reading(glob: str):
    """Batches of ``_path`` of files and archives, or of these and their content, to ``_path, value`` of all files."""
    def rows(batches: Iterable[pa.RecordBatch], wanted: re.Pattern) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            given = batch.column(1) if batch.num_columns > 1 else None
            for i, uri in enumerate(batch.column(0).to_pylist()):
                with io.BytesIO(given[i].as_py()) if given is not None else open(unquote(uri.removeprefix("file:")), "rb") as file:
                    if uri.endswith(ARCHIVES[1:]):
                        yield from _members(uri, file, wanted)
                    elif uri.endswith(GZIPPED):
                        yield uri.removesuffix(GZIPPED), gzip.decompress(file.read())
                    else:
                        yield uri, file.read()

    def contents_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("_path", pa.string()), ("value", pa.binary())
        held, size = [], 0
        for row in rows(batches, re.compile(fnmatch.translate(glob))):
            held.append(row)
            size += len(row[1])
            if len(held) == BATCH_ROWS or size >= BATCH_BYTES:
                yield _batch(held, *columns)
                held, size = [], 0
        yield _batch(held, *columns)

    return contents_of


def contents(names: DataFrame, glob: str) -> DataFrame:
    """``_path, value`` of the files that ``names`` (from ``paths``) lists, dealt to as many tasks as a shuffle has."""
    return _texts(spread(names.select("_path")).mapInArrow(_reading(glob), "_path string, value binary"))


def unpacked(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """The same of the files in archives below ``path`` where Spark's readers have to list and open them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", ARCHIVES)
    read = reader.load(path).select(F.col("_metadata.file_path").alias("_path"), "content")
    return _texts(read.mapInArrow(_reading(glob), "_path string, value binary"))


def _texts(read: DataFrame) -> DataFrame:
    return read.withColumn("value", F.col("value").cast("string"))
