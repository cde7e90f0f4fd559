"""Line codes of the form ``number-suffix``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: suffix of a line whose code has no dash.
DEFAULT_SUFFIX = 10


def line_number(code: Column) -> Column:
    """Part of the code before the first dash."""
    return F.split_part(code, F.lit("-"), F.lit(1))


def line_suffix(code: Column) -> Column:
    """Number after the first dash; the default without a dash; NULL if not a number."""
    dashed = F.contains(code, F.lit("-"))
    return F.when(
        dashed, F.split_part(code, F.lit("-"), F.lit(2)).try_cast("bigint")
    ).otherwise(F.lit(DEFAULT_SUFFIX).cast("bigint"))


def parse_target_ids(text: str | None) -> list[int]:
    """``"1, 2, 3"`` as a list; an unreadable or missing setting means no targets."""
    try:
        return [int(part) for part in text.split(",")]
    except (AttributeError, ValueError):
        return []
