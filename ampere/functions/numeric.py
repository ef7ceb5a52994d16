"""Numeric scalar expressions (all JVM-side Column expressions)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampere.functions.util import as_col

# A plain decimal / scientific number, or inf/infinity/nan, after trimming.
# Used as a guard so that strings Spark would accept but a strict parser
# would not (for example '1d' or '1f') become NULL.
NUMBER_PATTERN = r"^[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|inf|infinity|nan)$"


# Characters removed by ``strip`` (ASCII whitespace and no-break space).
STRIP_CHARS = " \t\n\r\x0b\x0c\xa0"


def strip(c) -> Column:
    """Remove leading/trailing whitespace (incl. no-break space), like ``str.strip``."""
    return F.btrim(as_col(c), F.lit(STRIP_CHARS))


def blank_to_null(c) -> Column:
    """Null or whitespace-only string → NULL, else the stripped string."""
    return F.nullif(strip(c), F.lit(""))


def parse_numeric(c) -> Column:
    """Lenient number parse: strip; empty, junk or non-numeric → NULL."""
    t = strip(c)
    return F.when(F.lower(t).rlike(NUMBER_PATTERN), t.try_cast("double"))


def strip_units(c, units: Iterable[str], thousands: bool = True) -> Column:
    """Remove literal unit suffixes (and thousands commas), then trim."""
    out = as_col(c)
    for u in units:
        out = F.replace(out, F.lit(u), F.lit(""))
    if thousands:
        out = F.replace(out, F.lit(","), F.lit(""))
    return strip(out)


def round_half_away(c, digits: int = 0) -> Column:
    """Round a double to ``digits`` places, half away from zero, on the binary
    value (scale, round to integer, unscale), so Spark and DuckDB agree."""
    c = as_col(c)
    if digits == 0:
        return F.round(c, 0)
    scale = float(10**digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def share_pct(parts: Iterable, total, digits: int = 1, scale: float = 100.0) -> Column:
    """``round(scale * sum(parts) / nullif(total, 0), digits)``."""
    num = reduce(lambda a, b: a + b, [as_col(p) for p in parts])
    return round_half_away(F.lit(scale) * num / F.nullif(as_col(total), F.lit(0.0)), digits)


def coalesce0(c) -> Column:
    """NULL → 0.0."""
    return F.coalesce(as_col(c).cast("double"), F.lit(0.0))


#: Decimals that are summed exactly.
EXACT_SCALE = 6


def exact_sum(c, scale: int = EXACT_SCALE) -> Column:
    """Sum that does not depend on the order of its values where they allow it.

    Values that are whole multiples of 10**-scale are summed as whole numbers.
    If a group has any other value (more decimals, NaN, an infinity, a
    magnitude at which a double no longer holds that many decimals), or if the
    sum leaves 64 bits, the group's sum is the plain double sum; nothing is
    rounded and nothing fails."""
    return F.expr(exact_sum_sql(f"`{c}`", scale)) if isinstance(c, str) else _exact_sum(as_col(c).cast("double"), scale)


def _exact_sum(d: Column, scale: int) -> Column:
    q = F.rint(d * float(10**scale)).try_cast("bigint")
    lossy = F.max(F.when(d.isNotNull(), q.isNull() | (F.abs(d) >= _whole_below(scale)) | (q.cast("double") / float(10**scale) != d)))
    unit = F.lit(f"{10**-scale:.{scale}f}").cast(f"decimal({scale},{scale})") if scale else F.lit(1)
    return F.when(lossy, F.sum(d)).otherwise(F.coalesce((F.try_sum(q).cast("decimal(20,0)") * unit).cast("double"), F.sum(d)))


def _whole_below(scale: int) -> float:
    """Doubles below this hold ``scale`` decimals."""
    return float(2**53 // 10**scale)


def exact_avg(c, scale: int = EXACT_SCALE) -> Column:
    """Average built from :func:`exact_sum` and a count of non-null values."""
    return F.expr(exact_avg_sql(f"`{c}`", scale)) if isinstance(c, str) else exact_sum(c, scale) / F.count(as_col(c)).cast("double")


# SQL-text forms of the same expressions, for wide projections built with
# ``selectExpr`` / ``F.expr`` (one JVM call per expression instead of one per
# Column function). They compute exactly what the Column forms compute.


def exact_sum_sql(expr: str, scale: int = EXACT_SCALE) -> str:
    d = f"CAST({expr} AS DOUBLE)"
    power = f"{float(10**scale)!r}D"
    q = f"TRY_CAST(rint({d} * {power}) AS BIGINT)"
    # two aggregates of plain numbers: the check and the whole numbers; the plain sum where they do not do
    lossy = f"max(CASE WHEN {d} IS NOT NULL THEN {q} IS NULL OR abs({d}) >= {_whole_below(scale)!r}D OR CAST({q} AS DOUBLE) / {power} <> {d} END)"
    unit = f"CAST({10**-scale:.{scale}f}BD AS DECIMAL({scale},{scale}))" if scale else "1"
    return f"(CASE WHEN {lossy} THEN sum({d}) ELSE coalesce(CAST(CAST(try_sum({q}) AS DECIMAL(20,0)) * {unit} AS DOUBLE), sum({d})) END)"


def exact_avg_sql(expr: str, scale: int = EXACT_SCALE) -> str:
    return f"({exact_sum_sql(expr, scale)} / CAST(count({expr}) AS DOUBLE))"


def round_half_away_sql(expr: str, digits: int = 0) -> str:
    if digits == 0:
        return f"round({expr}, 0)"
    scale = f"{float(10**digits)!r}D"
    return f"(round(({expr}) * {scale}, 0) / {scale})"


def share_pct_sql(parts, total: str, digits: int = 1, scale: float = 100.0) -> str:
    num = parts[0]
    for p in parts[1:]:
        num = f"({num} + {p})"
    return round_half_away_sql(f"{float(scale)!r}D * {num} / nullif({total}, 0.0D)", digits)
