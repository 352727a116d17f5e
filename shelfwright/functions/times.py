"""UTC time texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
_RUN = "yyyy-MM-dd'T'HH-mm-ss'Z'"


def iso_text(c: Column) -> Column:
    """``2024-01-31T05:06:07Z``; fractions of a second are cut."""
    return F.date_format(c, _ISO)


def run_text(c: Column) -> Column:
    """The same moment as a folder name, without colons."""
    return F.date_format(c, _RUN)


def parse_iso(c: Column) -> Column:
    """Timestamp of an ISO text; NULL when it is no such text."""
    return F.try_to_timestamp(c, F.lit(_ISO))


def parse_run(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit(_RUN))
