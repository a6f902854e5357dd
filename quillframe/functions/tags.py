"""Version tags such as 20230520T101112Z, and table names that end in one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG_PATTERN = r"^\d{8}T\d{6}Z$"
TAG_FORMAT = "yyyyMMdd'T'HHmmss'Z'"


def new_tag() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def make_tag(ts: Column | str) -> Column:
    """Tag of a UTC wall-clock timestamp column."""
    return F.date_format(ts, TAG_FORMAT)


def is_tag(col: Column | str) -> Column:
    return F.coalesce((F.col(col) if isinstance(col, str) else col).rlike(TAG_PATTERN), F.lit(False))


def parse_tag(col: Column | str) -> Column:
    """The moment a tag names, whatever the session time zone; null for a bad tag."""
    col = F.col(col) if isinstance(col, str) else col
    digits = F.when(is_tag(col), F.concat(F.substring(col, 1, 15), F.lit("+0000")))
    return F.try_to_timestamp(digits, F.lit("yyyyMMdd'T'HHmmssxx"))


def suffix_after_first(col: Column | str, sep: str = "_") -> Column:
    """What follows the first ``sep``, upper-cased; the whole text if there is none."""
    upper = F.upper(col)
    return F.substr(upper, F.instr(upper, sep.upper()) + F.lit(1))


def name_tag(col: Column | str) -> Column:
    """The version tag a table name ends in, null if it ends in none.

    Catalog names come back in lower case, tags are in upper case.
    """
    return F.nullif(F.regexp_extract(F.upper(col), r"_(\d{8}T\d{6}Z)$", 1), F.lit(""))


def tag_number(tag: Column) -> Column:
    """The 14 digits of a tag as one number, in time order."""
    return F.concat(F.substring(tag, 1, 8), F.substring(tag, 10, 6)).cast("bigint")


def number_tag(number: Column | str) -> Column:
    digits = F.lpad((F.col(number) if isinstance(number, str) else number).cast("string"), 14, "0")
    return F.concat(F.substring(digits, 1, 8), F.lit("T"), F.substring(digits, 9, 6), F.lit("Z"))
