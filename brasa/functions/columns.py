"""Column helpers: native Spark expressions only (no Python UDFs)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

DEC0 = DecimalType(38, 0)
DEC2 = DecimalType(38, 2)

# Fixed value: placeholder text that stands for NULL inside a surrogate key
# (the public surrogate-key convention of the modelling tool).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dec(p: int, s: int) -> DecimalType:
    return DecimalType(p, s)


def ts_ntz(text: str) -> Column:
    """Timestamp literal without time zone ('YYYY-MM-DD HH:MM:SS')."""
    return F.lit(text).cast("timestamp_ntz")


def date_lit(text: str) -> Column:
    return F.lit(text).cast("date")


def clean_text(col) -> Column:
    """Canonical category text: trim blanks, lower case, '' -> NULL."""
    return F.nullif(F.lower(F.trim(_c(col))), F.lit(""))


def trim_null(col) -> Column:
    """Trim blanks, keep case, '' -> NULL."""
    return F.nullif(F.trim(_c(col)), F.lit(""))


def safe_number(col) -> Column:
    """Text -> integer number, rounding halves away from zero; NULL on failure."""
    return _c(col).try_cast(DEC0)


def surrogate_key(*cols) -> Column:
    """md5 over the text form of the columns, NULL-safe, joined with '-'."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def ratio(num, den, num_scale: int = 0, den_scale: int = 0) -> Column:
    """Exact decimal ratio (scale 6), NULL when the denominator is 0 or NULL."""
    n = _c(num).cast(DecimalType(38, num_scale))
    d = _c(den).cast(DecimalType(38, den_scale))
    return n / F.nullif(d, F.lit(0).cast(DecimalType(38, den_scale)))


def round_dec(col, digits: int = 2, precision: int = 38) -> Column:
    """ROUND half away from zero on a decimal, typed decimal(precision, digits)."""
    return F.round(_c(col), digits).cast(DecimalType(precision, digits))


def pct(num, den, num_scale: int = 0, den_scale: int = 0, digits: int = 2) -> Column:
    """ROUND(num / NULLIF(den, 0) * 100, digits) in exact decimals."""
    return round_dec(ratio(num, den, num_scale, den_scale) * F.lit(100), digits)


def avg_dec(col, scale: int = 0) -> Column:
    """Average as an exact decimal ratio sum / count (scale 6); NULL on no rows."""
    c = _c(col).cast(DecimalType(38, scale))
    return F.sum(c) / F.nullif(F.count(c).cast(DEC0), F.lit(0).cast(DEC0))


def flag_eq(col, value) -> Column:
    """TRUE when col = value, FALSE otherwise (NULL -> FALSE)."""
    return F.coalesce(_c(col) == F.lit(value), F.lit(False))


def indicator(cond: Column) -> Column:
    """1 when the condition holds, 0 otherwise (NULL -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def band(col, bounds: Sequence[tuple], default: str) -> Column:
    """Ordered numeric bands: bounds = [(upper_inclusive, label), ...]."""
    c = _c(col)
    expr = None
    for upper, label in bounds:
        cond = c <= F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def attention_priority(level, days) -> Column:
    """Severity x age matrix -> 1 (most urgent) .. 7."""
    lv, d = _c(level), _c(days)
    return (F.when((lv == "alto") & (d > 7), 1).when(lv == "alto", 2)
            .when((lv == "medio") & (d > 30), 3).when(lv == "medio", 4)
            .when(d > 90, 5).when((lv == "bajo") & (d > 30), 6).otherwise(7)).cast("bigint")
