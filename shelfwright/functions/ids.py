"""Content ids: the same parts give the same id in every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwright.functions.text import strip


def id_part(c: Column, stripped: bool = False) -> Column:
    """Stripped lower-case text of one id part; NULL is the empty text.

    Doubles must be rendered by ``coerce.float_text`` first. ``stripped`` says
    that the text has no outer blanks any more.
    """
    text = c.cast("string")
    return F.coalesce(F.lower(text if stripped else strip(text)), F.lit(""))


def stable_id(prefix: str, *parts: Column, stripped: bool = False) -> Column:
    """``<prefix>_<sha256 of the parts joined by '|'>``."""
    joined = F.concat_ws("|", *[id_part(p, stripped) for p in parts])
    return F.concat(F.lit(f"{prefix}_"), F.sha2(joined, 256))


def url_hash(c: Column) -> Column:
    return F.sha2(c, 256)
