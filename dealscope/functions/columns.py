"""Small column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def recode(col: Column, mapping: Mapping[str, str] | None) -> Column:
    """Replace listed values, keep all others (NULL stays NULL)."""
    if not mapping:
        return col
    out = None
    for old, new in mapping.items():
        out = (F.when(col == F.lit(old), F.lit(new)) if out is None
               else out.when(col == F.lit(old), F.lit(new)))
    return out.otherwise(col)


# Accepted shapes of untrusted text; anything else becomes NULL.  Dates: year, month, day with
# one kind of separator (- / blank or backslash), optionally a time of day, which is dropped.
# Numbers: decimal digits with single underscores between them, a point, an exponent; inf and
# nan by name; no type suffixes, no hexadecimal.
_DATE_TEXT = r"^\s*(\d{1,6})([-/ \\])(\d{1,2})\2(\d{1,2})(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?\s*$"
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER_TEXT = (rf"^\s*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
                r"|(?i:inf|infinity|nan))\s*$")


def date_of_text(col: Column) -> Column:
    """A date written as year, month, day; NULL for any other text or an impossible day."""
    def part(i: int, width: int) -> Column:
        return F.lpad(F.regexp_extract(col, _DATE_TEXT, i), width, "0")

    year = F.regexp_extract(col, _DATE_TEXT, 1)
    iso = F.concat_ws("-", F.when(F.length(year) < 4, F.lpad(year, 4, "0")).otherwise(year), part(3, 2), part(4, 2))
    return F.when(col.rlike(_DATE_TEXT), iso).try_cast("date")


def double_of_text(col: Column) -> Column:
    """A decimal number; NULL for any other text."""
    return F.when(col.rlike(_NUMBER_TEXT), F.trim(F.replace(col, F.lit("_"), F.lit("")))).try_cast("double")


def typed(df: DataFrame, name: str, dtype: str) -> Column:
    """Column ``name`` as ``dtype``; untrusted strings are checked against the accepted
    shapes first, so that bad values become NULL.  Integer targets parse the text as a
    double first and round half away from zero."""
    field = df.schema[name].dataType
    col = F.col(name)
    if isinstance(field, T.StringType):
        if dtype in ("int", "bigint"):
            return F.round(double_of_text(col)).try_cast(dtype)
        if dtype == "double":
            return double_of_text(col)
        if dtype == "date":
            return date_of_text(col)
        return col.try_cast(dtype)
    return col.cast(dtype)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL (never inf or NaN) when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))


def clip(col: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.least(col, F.lit(hi)), F.lit(lo))


def num_or(col: Column, default: float = 0.0) -> Column:
    """Numeric coercion with default: bad text, NULL and NaN -> ``default``."""
    as_double = col.try_cast("double")          # the column is numeric in every caller
    return F.coalesce(F.nanvl(as_double, F.lit(None).cast("double")), F.lit(float(default)))


def md5_hash32(key: Column, seed: int) -> Column:
    """First 8 hex digits of md5(key || '-' || seed) as an integer in [0, 2**32)."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
