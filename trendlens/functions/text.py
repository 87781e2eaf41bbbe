"""Text and tag helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendlens.schema import NO_TAGS


def tag_list(c: Column) -> Column:
    """``"a"|"b"`` to an array; the marker for no tags becomes one empty tag."""
    bare = F.when(c == NO_TAGS, F.lit("")).otherwise(F.replace(c, F.lit('"'), F.lit("")))
    return F.split(bare, r"\|")


def join_tags(c: Column) -> Column:
    return F.concat_ws("|", c)


def ellipsize(c: Column, n: int, always: bool = False) -> Column:
    """First ``n`` characters, with ``...`` when cut (or on every value)."""
    short = F.concat(F.substring(c, 1, n), F.lit("..."))
    return short if always else F.when(F.length(c) > n, short).otherwise(c)


def present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def to_message(*columns: str) -> Column:
    """One JSON object per row; without names, of all columns."""
    return F.to_json(F.struct(*(columns or ("*",))))
