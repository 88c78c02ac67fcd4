"""String helpers (F-01..F-06, F-14, F-15, S-02)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The raw layer's null tokens (besides the empty field).
NULL_TOKENS = ("\\N", "NULL", "NUL", "")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens_to_null(c) -> Column:
    """Every null token becomes NULL; Spark's csv ``nullValue`` takes one only."""
    col = _col(c)
    return F.when(~col.isin(*NULL_TOKENS), col)


def strip_code_prefix(code) -> Column:
    """``RIGHT(code, LEN(code) - 3)::int`` written back to text: 'LGA10050' -> '10050'.

    The cast to int in between normalises leading zeros and signs, and the
    result is stored in a text column again (Q-10)."""
    c = _col(code)
    digits = F.right(c, F.length(c) - F.lit(3))
    return digits.try_cast("bigint").cast("string")


def file_name(path) -> Column:
    """Last path segment (``split_part(path, '/', -1)``)."""
    return F.split_part(_col(path), F.lit("/"), F.lit(-1))


def month_from_file_name(path) -> Column:
    """First day of the snapshot month encoded as ``MM_YYYY...`` in the file
    name (F-15, Q-18).  A name that is not a valid month gives NULL."""
    name = file_name(path)
    mth = F.substring(name, 1, 2)
    yr = F.substring(name, 4, 4)
    return F.try_to_date(F.concat_ws("-", yr, mth, F.lit("01")), "yyyy-MM-dd")
