"""Keyword classification: ordered rules, first hit wins (F1, F2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampere.functions.numeric import strip
from ampere.functions.util import as_col

Rules = Sequence[tuple[str, Sequence[str]]]

# Generator-name keywords per fuel, checked in this order on the
# lower-cased name with plain substring tests; no hit → "other".
FUEL_RULES: Rules = [
    ("nuclear", ["nuclear", "pickering", "darlington", "bruce"]),
    ("wind", ["wind"]),
    ("solar", ["solar", " pv"]),
    ("biofuel", ["biofuel", "biomass", "bio fuel"]),
    (
        "hydro",
        [
            "beck",
            "niagara falls",
            "hydro",
            "lac ",
            "chenaux",
            "madawaska",
            "des joachims",
            "saunders",
            "arnprior",
            "queenston",
            "ottawa river",
        ],
    ),
    ("gas", ["gas", "cogen", "ccgt", "lennox", " gu "]),
]


def name_key(c) -> Column:
    """Dictionary key of a name: strip + upper (F1)."""
    return F.upper(strip(as_col(c)))


def classify(c, rules: Rules = FUEL_RULES, default: str = "other") -> Column:
    """Ordered keyword rules over ``lower(c)``; first matching class wins."""
    low = F.lower(as_col(c))
    expr = None
    for cls, words in rules:
        cond = None
        for w in words:
            hit = low.contains(w)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def to_known_class(c, classes: Sequence[str], other: str = "other") -> Column:
    """A class outside ``classes`` counts as ``other``."""
    c = as_col(c)
    return F.when(c.isin(*classes), c).otherwise(F.lit(other))
