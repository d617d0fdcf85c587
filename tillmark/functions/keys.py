"""Surrogate keys, names and text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for a null part of a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str) -> Column:
    """md5 over the parts joined by '-', each part as text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY_PART)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def full_name(first: str, middle: str, last: str) -> Column:
    """A missing initial leaves two blanks; a missing first or last name makes the whole name null."""
    return F.concat(F.col(first), F.lit(" "), F.coalesce(F.col(middle), F.lit("")), F.lit(" "), F.col(last))


def short_name(first: str, last: str) -> Column:
    """Name without initial; missing parts are left out."""
    blank = F.lit("")
    return F.trim(F.concat(F.coalesce(F.col(first), blank), F.lit(" "), F.coalesce(F.col(last), blank)))


def text_key(column: Column) -> Column:
    """Lower case, only ``[a-z0-9 ]`` kept, runs of blanks collapsed; the join key of place names."""
    kept = F.regexp_replace(F.lower(F.trim(F.coalesce(column, F.lit("")))), "[^a-z0-9 ]+", "")
    return F.trim(F.regexp_replace(kept, " +", " "))
