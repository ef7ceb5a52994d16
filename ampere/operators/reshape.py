"""Wide ↔ long reshaping and dictionary classification.

``pivot_sum`` uses conditional sums rather than ``groupBy().pivot()``: one
hash aggregate with a map-side partial step and one shuffle, and no extra
job to discover the pivot values (the class list is fixed).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.functions.classify import FUEL_RULES, Rules, classify, name_key, to_known_class
from ampere.functions.numeric import exact_sum, exact_sum_sql


def melt(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | None = None,
    var: str = "variable",
    value: str = "value",
    value_type: str = "double",
) -> DataFrame:
    """Wide → long (A1); values cast to one type first. No shuffle."""
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    casted = df.select(*ids, *[F.col(v).cast(value_type).alias(v) for v in values])
    return casted.unpivot(list(ids), values, var, value)


def pivot_sum(
    df: DataFrame,
    keys: Sequence,
    class_col: str,
    value_col: str,
    classes: Sequence[str],
    exact_scale: int | None = None,
    zero_fill: bool = True,
    extra_aggs: Sequence[Column] = (),
) -> DataFrame:
    """Sum ``value_col`` per (keys, class) and spread classes to columns (A2);
    a class with no row is 0 (or NULL when ``zero_fill`` is False).
    ``exact_scale`` sums as decimal with that many places (order-independent)."""

    if isinstance(class_col, str) and isinstance(value_col, str):
        # one SQL expression per class (cheap to build for many classes)
        aggs = []
        for cls in classes:
            cond = f"CASE WHEN `{class_col}` = '{cls}' THEN `{value_col}` END"
            agg = exact_sum_sql(cond, exact_scale) if exact_scale is not None else f"sum({cond})"
            aggs.append(F.expr(f"coalesce({agg}, CAST(0 AS DOUBLE)) AS `{cls}`" if zero_fill else f"{agg} AS `{cls}`"))
        return df.groupBy(*keys).agg(*aggs, *extra_aggs)

    def total(c: Column) -> Column:
        return exact_sum(c, exact_scale) if exact_scale is not None else F.sum(c)

    aggs = []
    for cls in classes:
        s = total(F.when(F.col(class_col) == F.lit(cls), F.col(value_col)))
        aggs.append((F.coalesce(s, F.lit(0.0)) if zero_fill else s).alias(cls))
    return df.groupBy(*keys).agg(*aggs, *extra_aggs)


def prefer_total(total, parts: Sequence) -> Column:
    """Reported total when present, else the sum of the parts (A3)."""
    total = F.col(total) if isinstance(total, str) else total
    s = reduce(lambda a, b: a + b, [F.col(p) if isinstance(p, str) else p for p in parts])
    return F.coalesce(total, s)


def unique_mapping(mapping: DataFrame, key_col: str, value_col: str, pick: str = "min") -> DataFrame:
    """Make a name→class dictionary unique per normalised key, so a join with
    it cannot fan out. ``pick`` chooses among duplicates (min/max)."""
    agg = F.min if pick == "min" else F.max
    return (
        mapping.select(name_key(key_col).alias("_mkey"), F.lower(F.col(value_col)).alias("_mclass"))
        .groupBy("_mkey")
        .agg(agg("_mclass").alias("_mclass"))
    )


def classify_lookup(
    df: DataFrame,
    name_col: str,
    mapping: DataFrame | None,
    classes: Sequence[str],
    rules: Rules = FUEL_RULES,
    out: str = "class",
) -> DataFrame:
    """Mapped class, else the rule-inferred class; unknown classes → 'other' (J4).

    ``mapping`` must already be unique per key (``unique_mapping``); the
    join is left to the byte threshold and to run-time re-planning. An empty mapped class falls
    through to the rules, as an ``or`` would."""
    inferred = classify(F.col(name_col), rules)
    if mapping is None:
        return df.withColumn(out, to_known_class(inferred, classes))
    joined = df.join(mapping, name_key(F.col(name_col)) == F.col("_mkey"), "left")
    cls = F.coalesce(F.nullif(F.col("_mclass"), F.lit("")), inferred)
    return joined.withColumn(out, to_known_class(cls, classes)).drop("_mkey", "_mclass")


def classify_names(
    spark,
    names: Sequence[str],
    mapping: DataFrame | None,
    classes: Sequence[str],
    rules: Rules = FUEL_RULES,
) -> dict[str, str]:
    """Class of each column name: the same ``classify_lookup`` expression as
    for rows, run by Spark over the list of names. The result is schema
    metadata — one entry per column — so it is returned to the driver."""
    if not names:
        return {}
    df = spark.createDataFrame([(n,) for n in names], "_plant string")
    return {r["_plant"]: r["_fuel"] for r in classify_lookup(df, "_plant", mapping, classes, rules, out="_fuel").collect()}


def plants_to_fuels(
    wide: DataFrame,
    id_cols: Sequence[str],
    mapping: DataFrame | None,
    total_col: str | None = "TOTAL",
    classes: Sequence[str] = ("nuclear", "gas", "hydro", "wind", "solar", "biofuel", "other"),
    rules: Rules = FUEL_RULES,
    row_col: str = "_row",
) -> DataFrame:
    """Plant-level wide table → one row per input row with a column per fuel
    class and ``total`` (M6: classify plants → per-class sums → prefer the
    reported total).

    Plants are columns, so they are classified once as metadata
    (:func:`classify_names`) and each output class is a sum over its columns
    inside one projection: no melt, no join, no shuffle, whatever the width.
    Blank or NULL cells are skipped; a class without cells is 0. Sums run in
    column order, as a row loop over the columns would. ``row_col`` carries
    the input row order (the input's own column of that name, where it has
    one) for a first-wins dedupe by timestamp afterwards (A10).
    """
    tot_names = {total_col.upper()} if total_col else set()
    plant_cols = [c for c in wide.columns if c not in {*id_cols, row_col} and c.upper() not in tot_names]
    tcol = next((c for c in wide.columns if c.upper() in tot_names), None)
    cls = classify_names(wide.sparkSession, plant_cols, mapping, classes, rules)

    def cell(c: str) -> Column:
        v = F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))
        return F.coalesce(v.cast("double"), F.lit(0.0))

    sums = []
    for k in classes:
        members = [cell(c) for c in plant_cols if cls.get(c) == k]
        if not members:
            expr = F.lit(0.0)
        elif len(members) == 1:
            expr = F.lit(0.0) + members[0]
        else:
            expr = F.aggregate(F.array(*members), F.lit(0.0), lambda acc, x: acc + x)
        sums.append(expr.alias(k))
    reported = F.col(f"`{tcol}`").cast("double") if tcol else F.lit(None).cast("double")
    row = F.col(row_col) if row_col in wide.columns else F.monotonically_increasing_id().alias(row_col)
    out = wide.select(*id_cols, row, reported.alias("_reported"), *sums)
    return out.withColumn("total", prefer_total("_reported", list(classes))).drop("_reported")


def cells_to_long(df: DataFrame, headers: str, cells: str, var: str = "column", value: str = "value") -> DataFrame:
    """Row of cells + header list → long (column, value) pairs (F10). Cells
    without a header and headers without a cell are left out; a header that
    occurs twice has a row for each."""
    from ampere.functions.text import zip_shortest

    rest = [F.col(f"`{c}`") for c in df.columns if c not in (headers, cells)]
    pairs = df.select(*rest, F.explode(zip_shortest(headers, cells)).alias("_z"))
    return pairs.select(*rest, F.col("_z").getField("0").alias(var), F.col("_z").getField("1").alias(value))


def posexplode_zip(df: DataFrame, a: str, b: str, keep: Sequence[str], names=("left", "right")) -> DataFrame:
    """Positional zip of two array columns that stops at the shorter (J5),
    one output row per position."""
    from ampere.functions.text import zip_shortest

    z = df.select(*keep, F.posexplode(zip_shortest(a, b)).alias("pos", "_z"))
    return z.select(
        *keep,
        F.col("pos").cast("bigint").alias("pos"),
        F.col("_z").getField("0").alias(names[0]),
        F.col("_z").getField("1").alias(names[1]),
    )
