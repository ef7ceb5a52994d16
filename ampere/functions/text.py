"""String scalar expressions used when cleaning landed tables and pages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampere.functions.numeric import strip
from ampere.functions.util import as_col

# Substitutions applied to table header cells, in order,
# each followed by a trim.
HEADER_SUBS = [("\xa0", " "), ("\n", ""), ("   ", " "), ("*", "")]
# Substitutions applied to table body cells, in order.
CELL_SUBS = [("*", ""), (",", "")]

# The seasonal threshold cell pattern, "<a> (Summer) <b> (Winter)".
SEASONAL_PATTERN = r"(\S+) \(Summer\)\s+(\S+) \(Winter\)"


def replace_chain(c, subs: Iterable[tuple[str, str]]) -> Column:
    """Literal replacements applied in order, trimming after each step."""
    out = as_col(c)
    for a, b in subs:
        out = strip(F.replace(out, F.lit(a), F.lit(b)))
    return out


def clean_header(c) -> Column:
    return replace_chain(c, HEADER_SUBS)


def clean_cell(c) -> Column:
    return replace_chain(c, CELL_SUBS)


def camel_to_snake(c) -> Column:
    """``netImportExports`` → ``net_import_exports``."""
    c = as_col(c)
    return F.lower(F.regexp_replace(c, r"(?<!^)(?=[A-Z])", "_"))


def normalize_header_name(name: str) -> str:
    """strip + lower + blank→underscore, for column names (S2; driver metadata)."""
    return name.strip().lower().replace(" ", "_")


def seasonal_split(c) -> tuple[Column, Column]:
    """``'600 (Summer)  1000 (Winter)'`` → (``'600'``, ``'1000'``); a cell that
    does not match is copied to both outputs (F7)."""
    c = as_col(c)
    hit = c.rlike(SEASONAL_PATTERN)
    summer = F.when(hit, F.regexp_extract(c, SEASONAL_PATTERN, 1)).otherwise(c)
    winter = F.when(hit, F.regexp_extract(c, SEASONAL_PATTERN, 2)).otherwise(c)
    return summer, winter


def conditional_fill(higher, lower, summer, winter) -> tuple[Column, Column, Column]:
    """Blank higher tier → both thresholds ``'0'`` and higher := lower (F8).

    Returns (higher, summer, winter)."""
    higher, lower, summer, winter = map(as_col, (higher, lower, summer, winter))
    blank = higher == F.lit("")
    return (
        F.when(blank, lower).otherwise(higher),
        F.when(blank, F.lit("0")).otherwise(summer),
        F.when(blank, F.lit("0")).otherwise(winter),
    )


def pad_array(cells, n) -> Column:
    """Pad a ragged row with ``''`` up to ``n`` cells."""
    cells = as_col(cells)
    n = F.lit(n) if isinstance(n, int) else as_col(n)
    return F.concat(cells, F.array_repeat(F.lit(""), F.greatest(n - F.size(cells), F.lit(0))))


def zip_shortest(a, b) -> Column:
    """Positional zip of two arrays that stops at the shorter one (J5);
    ``arrays_zip`` alone would pad the shorter side with NULLs."""
    a, b = as_col(a), as_col(b)
    n = F.least(F.size(a), F.size(b))
    return F.arrays_zip(F.slice(a, 1, n), F.slice(b, 1, n))
