"""Registered queries over the driver's tables, each with an equivalent DuckDB
SQL oracle (same column names and types).

Mapping of the grid data model onto the given tables:

* ``events`` plays the hourly readings / generation source: ``ts`` is the
  reading time, ``event_type`` the fuel class, ``value`` the MW reading,
  ``user_id`` a source id for run-log style reports (``error`` = failed run);
* ``lineitem`` / ``part`` play the plant-level history (part name words
  classify into classes, quantities summed per month);
* ``orders`` plays the rate history (priority = rate type, order date =
  effective date, total price = value);
* ``pages`` plays the landed web pages.

Every query reads whole tables. Values with at most two decimals are summed
as decimals (order-independent), and doubles are rounded half away from zero
by scaling (see ``round_half_away``), so both engines produce equal bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.functions import (
    camel_to_snake,
    classify,
    clean_cell,
    clean_header,
    conditional_fill,
    exact_avg,
    exact_sum,
    hour_ending_to_start,
    iso_hour,
    iso_seconds,
    name_key,
    pad_array,
    parse_long_date,
    parse_numeric,
    parse_reading_time,
    round_half_away,
    seasonal_split,
    share_pct,
    strip_units,
    to_known_class,
    to_utc_naive,
    trunc_ntz,
)
from ampere.functions.numeric import NUMBER_PATTERN
from ampere.operators import keyed, quality, reports
from ampere.operators.joins import hourly_full_outer
from ampere.operators.reshape import classify_lookup, melt, pivot_sum, prefer_total, unique_mapping
from ampere.sources.files import month_sequence, select_present
from ampere.sources.html import element_texts, extract_labelled, html_headings, html_list_items, links
from ampere.plans.backfill import rename_keep
from ampere.schemas import INPUT_TABLES

Query = Callable[[SparkSession, str], DataFrame]

# Event types, in the order their pivot columns appear.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# Event types counted as "clean" in the share.
CLEAN_TYPES = ["click", "signup", "view"]
# Keyword rules for part names; an adjective rule precedes the
# noun rules to exercise precedence, and its class is not a pivot class.
PART_RULES = [
    ("hot", ["hot "]),
    ("bolt", ["bolt"]),
    ("ring", ["ring"]),
    ("gear", ["gear"]),
    ("plate", ["plate"]),
    ("rod", ["rod"]),
    ("widget", ["widget"]),
]
PART_CLASSES = ["bolt", "ring", "gear", "plate", "rod", "widget", "other"]
PART_TYPES = ["economy", "large", "medium", "promo", "small", "standard"]
LINEITEM_ORDER = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
LINE_KEY = ["l_orderkey", "l_linenumber"]
# Parameters of the registered queries.
HIST_BEFORE = "2024-01-20 00:00:00"
LIVE_FROM = "2024-01-10 00:00:00"
BATCH_FROM = "2024-01-15 00:00:00"
ASOF_WALL = "2024-01-25 00:00:00"
FRESH_ASOF = "2024-01-31 00:30:00"
INCR_TARGET_BEFORE = "2000-01-01 00:00:00"
READING_ASOF = "2002-01-15"
URGENT = "1-URGENT"
# English weekday (Sunday first, as dayofweek counts) and month abbreviations.
WEEKDAY_ABBR = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
MONTH_ABBR_TITLE = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

ORACLE: dict[str, str] = {}
QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    """An input table, read with its declared schema (see ``schemas.INPUT_TABLES``)."""
    r = spark.read
    if name in INPUT_TABLES:
        r = r.schema(INPUT_TABLES[name])
    return r.parquet(f"{d.rstrip('/')}/{name}.parquet")


def ts_lit(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


# ── SQL fragment helpers (oracle side) ───────────────────────────────────────


def q_round(expr: str, n: int) -> str:
    return f"round({expr}, 0)" if n == 0 else f"(round(({expr}) * 1e{n}, 0) / 1e{n})"


def q_exact_sum(expr: str) -> str:
    """The plain rule: values are taken to six decimals, which the given tables'
    values have at most, and summed exactly."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(38,6))) AS DOUBLE)"


def q_exact_avg(expr: str) -> str:
    return f"({q_exact_sum(expr)} / CAST(count({expr}) AS DOUBLE))"


def q_case(expr: str, rules) -> str:
    parts = []
    for cls, words in rules:
        conds = " OR ".join(f"contains(lower({expr}), '{w}')" for w in words)
        parts.append(f"WHEN {conds} THEN '{cls}'")
    return "CASE " + " ".join(parts) + " ELSE 'other' END"


def q_known(expr: str, classes) -> str:
    lst = ", ".join(f"'{c}'" for c in classes)
    return f"CASE WHEN {expr} IN ({lst}) THEN {expr} ELSE 'other' END"


Q_STRIP = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160)"


def q_strip(expr: str) -> str:
    return f"trim({expr}, {Q_STRIP})"


def q_parse_numeric(expr: str) -> str:
    s = q_strip(expr)
    return f"(CASE WHEN regexp_full_match(lower({s}), '{NUMBER_PATTERN}') THEN try_cast({s} AS DOUBLE) END)"


def q_seconds(later: str, earlier: str) -> str:
    return f"(CAST(epoch_us({later}) - epoch_us({earlier}) AS DOUBLE) / 1e6)"


# ── shared building blocks ───────────────────────────────────────────────────


def hourly_pivot_of(ev: DataFrame) -> DataFrame:
    """events → one row per hour, a column per event type + total."""
    ev = ev.withColumn("hour", trunc_ntz("hour", "ts"))
    return pivot_sum(ev, ["hour"], "event_type", "value", EVENT_TYPES, exact_scale=2, extra_aggs=[exact_sum("value").alias("total")])


def hourly_pivot(spark: SparkSession, d: str) -> DataFrame:
    return hourly_pivot_of(t(spark, d, "events"))


Q_PIVOT = (
    "SELECT date_trunc('hour', ts) AS hour, "
    + ", ".join(
        f"coalesce({q_exact_sum(f'CASE WHEN event_type = {chr(39)}{c}{chr(39)} THEN value END')}, CAST(0 AS DOUBLE)) AS {c}"
        for c in EVENT_TYPES
    )
    + f", {q_exact_sum('value')} AS total FROM events GROUP BY 1"
)


def fct_events(spark: SparkSession, d: str) -> DataFrame:
    """Hourly generation-style fact from events (M4 shape)."""
    p = hourly_pivot(spark, d)
    return p.select(
        "hour",
        trunc_ntz("day", "hour").alias("day"),
        trunc_ntz("month", "hour").alias("month"),
        *EVENT_TYPES,
        "total",
        share_pct(CLEAN_TYPES, "total", 1).alias("clean_pct"),
    )


Q_FCT = f"""
WITH p AS ({Q_PIVOT})
SELECT hour, date_trunc('day', hour) AS day, date_trunc('month', hour) AS month,
       {", ".join(EVENT_TYPES)}, total,
       {q_round("100.0 * ((click + signup) + view) / nullif(total, 0)", 1)} AS clean_pct
FROM p"""


def purchase_vs_error(spark: SparkSession, d: str, strategy: str = "split", since=None) -> DataFrame:
    """Flagship (M5 shape): purchases per hour ⟗ first error reading per hour.

    ``since`` (an hour-aligned bound) keeps only output hours >= it; it is
    applied to the raw rows of both sides, which is equivalent because the
    output hour of every row equals the hour of the side(s) it came from."""
    ev = t(spark, d, "events")
    if since is not None:
        ev = ev.filter(F.col("ts") >= since)
    left = (
        ev.filter(F.col("event_type") == "purchase")
        .groupBy(trunc_ntz("hour", "ts").alias("hour"))
        .agg(exact_sum("value").alias("purchase_value"), F.count(F.lit(1)).alias("n_purchases"))
    )
    err = ev.filter(F.col("event_type") == "error").withColumn("_h", trunc_ntz("hour", "ts"))
    right = keyed.dedupe_latest(err, ["_h"], [F.col("ts").asc(), F.col("event_id").asc()]).select(
        "ts", "value", "user_id"
    )
    return hourly_full_outer(
        left,
        right,
        "hour",
        "ts",
        right_cols=["value", "user_id"],
        rename={"value": "err_value", "user_id": "err_user_id"},
        left_flag="has_purchase",
        right_flag="has_error",
        strategy=strategy,
    )


Q_FLAGSHIP = f"""
WITH g AS (
  SELECT date_trunc('hour', ts) AS hour, {q_exact_sum('value')} AS purchase_value, count(*) AS n_purchases
  FROM events WHERE event_type = 'purchase' GROUP BY 1),
e AS (
  SELECT ts, value, user_id FROM events WHERE event_type = 'error'
  QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST) = 1)
SELECT coalesce(g.hour, date_trunc('hour', e.ts)) AS hour, g.purchase_value, g.n_purchases,
       e.value AS err_value, e.user_id AS err_user_id,
       g.hour IS NOT NULL AS has_purchase, e.ts IS NOT NULL AS has_error
FROM g FULL OUTER JOIN e ON date_trunc('hour', e.ts) = g.hour"""


# ── 2.6 windows / keyed ──────────────────────────────────────────────────────


@register(
    "dedupe_priority",
    f"""
WITH u AS (
  SELECT date_trunc('hour', ts) AS hour, ts, event_id, value, 0 AS p FROM events WHERE ts < TIMESTAMP '{HIST_BEFORE}'
  UNION ALL
  SELECT date_trunc('hour', ts) AS hour, ts, event_id, value + 1000 AS value, 1 AS p FROM events WHERE ts >= TIMESTAMP '{LIVE_FROM}')
SELECT hour, ts, event_id, value FROM u
QUALIFY row_number() OVER (PARTITION BY hour ORDER BY p DESC, ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1""",
)
def dedupe_priority(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events").withColumn("hour", trunc_ntz("hour", "ts"))
    hist = ev.filter(F.col("ts") < ts_lit(HIST_BEFORE)).select("hour", "ts", "event_id", "value")
    live = ev.filter(F.col("ts") >= ts_lit(LIVE_FROM)).select(
        "hour", "ts", "event_id", (F.col("value") + F.lit(1000.0)).alias("value")
    )
    return keyed.latest_by_priority(
        (hist, 0), (live, 1), keys=["hour"], tiebreak=[F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()]
    )


def _line_order_sql(first: str) -> str:
    rest = ", ".join(f"{c} ASC NULLS FIRST" for c in LINEITEM_ORDER)
    return f"{first}, {rest}"


@register(
    "dedupe_composite",
    f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {_line_order_sql('l_shipdate DESC NULLS LAST')}) = 1""",
)
def dedupe_composite(spark: SparkSession, d: str) -> DataFrame:
    li = t(spark, d, "lineitem")
    order = [F.col("l_shipdate").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in LINEITEM_ORDER]]
    return keyed.dedupe_latest(li, LINE_KEY, order)


@register(
    "dedupe_first",
    f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {_line_order_sql('l_shipdate ASC NULLS FIRST')}) = 1""",
)
def dedupe_first(spark: SparkSession, d: str) -> DataFrame:
    li = t(spark, d, "lineitem")
    return keyed.dedupe_first(li, LINE_KEY, ["l_shipdate", *LINEITEM_ORDER])


@register(
    "upsert_by_key",
    f"""
SELECT event_id, ts, event_type, value FROM events
WHERE ts < TIMESTAMP '{HIST_BEFORE}'
  AND event_id NOT IN (SELECT event_id FROM events WHERE ts >= TIMESTAMP '{BATCH_FROM}')
UNION ALL
SELECT event_id, ts, event_type, value + 1000 AS value FROM events WHERE ts >= TIMESTAMP '{BATCH_FROM}'""",
)
def upsert_by_key(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events").select("event_id", "ts", "event_type", "value")
    target = ev.filter(F.col("ts") < ts_lit(HIST_BEFORE))
    batch = ev.filter(F.col("ts") >= ts_lit(BATCH_FROM)).withColumn("value", F.col("value") + F.lit(1000.0))
    return keyed.upsert(target, batch, ["event_id"])


@register(
    "insert_absent",
    f"""
WITH target AS (SELECT *, 'stored' AS note FROM lineitem WHERE l_returnflag = 'R'),
b AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY {_line_order_sql('l_shipdate ASC NULLS FIRST')}) = 1)
SELECT * FROM target
UNION ALL BY NAME
SELECT * FROM b WHERE NOT EXISTS (
  SELECT 1 FROM target x WHERE x.l_orderkey = b.l_orderkey AND x.l_linenumber = b.l_linenumber)""",
)
def insert_absent(spark: SparkSession, d: str) -> DataFrame:
    li = t(spark, d, "lineitem")
    target = li.filter(F.col("l_returnflag") == "R").withColumn("note", F.lit("stored"))
    return keyed.insert_absent(target, li, LINE_KEY, batch_order=["l_shipdate", *LINEITEM_ORDER])


@register(
    "anti_not_in",
    f"""
SELECT * FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderpriority = '{URGENT}' AND o_orderstatus = 'F')""",
)
def anti_not_in(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer")
    o = t(spark, d, "orders").filter((F.col("o_orderpriority") == URGENT) & (F.col("o_orderstatus") == "F"))
    return keyed.not_in(c, o, "c_custkey", "o_custkey")


@register(
    "anti_composite",
    """
SELECT * FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R'
   AND r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber)""",
)
def anti_composite(spark: SparkSession, d: str) -> DataFrame:
    li = t(spark, d, "lineitem")
    return keyed.anti_join(li, li.filter(F.col("l_returnflag") == "R"), LINE_KEY)


# ── 2.5 aggregations / reshape ───────────────────────────────────────────────


@register("pivot_hourly", Q_PIVOT)
def pivot_hourly(spark: SparkSession, d: str) -> DataFrame:
    return hourly_pivot(spark, d)


@register(
    "share_pct",
    f"""
WITH p AS ({Q_PIVOT})
SELECT hour,
  {q_round("100.0 * ((click + signup) + view) / nullif(total, 0)", 1)} AS clean_pct,
  {q_round("100.0 * view / nullif(purchase, 0)", 1)} AS view_per_purchase_pct
FROM p""",
)
def share_pct_q(spark: SparkSession, d: str) -> DataFrame:
    p = hourly_pivot(spark, d)
    return p.select(
        "hour",
        share_pct(CLEAN_TYPES, "total", 1).alias("clean_pct"),
        share_pct(["view"], "purchase", 1).alias("view_per_purchase_pct"),
    )


@register(
    "calendar_buckets",
    """
SELECT event_id, ts, date_trunc('hour', ts) AS hour, date_trunc('day', ts) AS day,
       date_trunc('month', ts) AS month FROM events""",
)
def calendar_buckets(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    return ev.select(
        "event_id", "ts", trunc_ntz("hour", "ts").alias("hour"), trunc_ntz("day", "ts").alias("day"),
        trunc_ntz("month", "ts").alias("month"),
    )


@register("fct_generation", Q_FCT)
def fct_generation(spark: SparkSession, d: str) -> DataFrame:
    return fct_events(spark, d)


_PART_CASE = q_case("p_name", PART_RULES)


@register(
    "plant_fuel_pivot",
    f"""
WITH j AS (
  SELECT date_trunc('month', l.l_shipdate) AS month, l.l_quantity, l.l_linestatus,
         {q_known(f'({_PART_CASE})', PART_CLASSES)} AS cls
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
a AS (
  SELECT month, {", ".join(f"coalesce({q_exact_sum(f'CASE WHEN cls = {chr(39)}{c}{chr(39)} THEN l_quantity END')}, CAST(0 AS DOUBLE)) AS {c}" for c in PART_CLASSES)},
         {q_exact_sum("CASE WHEN l_linestatus = 'O' THEN l_quantity END")} AS reported
  FROM j GROUP BY month)
SELECT month, {", ".join(PART_CLASSES)},
       coalesce(reported, {" + ".join(PART_CLASSES)}) AS total
FROM a""",
)
def plant_fuel_pivot(spark: SparkSession, d: str) -> DataFrame:
    li = t(spark, d, "lineitem")
    part = t(spark, d, "part").select("p_partkey", "p_name")
    j = li.join(part, li["l_partkey"] == part["p_partkey"])
    j = j.select(
        trunc_ntz("month", "l_shipdate").alias("month"),
        "l_quantity",
        "l_linestatus",
        to_known_class(classify("p_name", PART_RULES), PART_CLASSES).alias("cls"),
    )
    reported = exact_sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))).alias("reported")
    a = pivot_sum(j, ["month"], "cls", "l_quantity", PART_CLASSES, exact_scale=2, extra_aggs=[reported])
    return a.select("month", *PART_CLASSES, prefer_total("reported", PART_CLASSES).alias("total"))


@register(
    "classify_rules",
    f"SELECT p_partkey, p_name, upper(trim(p_name)) AS name_key, {_PART_CASE} AS class FROM part",
)
def classify_rules(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part")
    return p.select("p_partkey", "p_name", name_key("p_name").alias("name_key"), classify("p_name", PART_RULES).alias("class"))


@register(
    "classify_lookup",
    f"""
WITH m AS (SELECT upper(trim(p_name)) AS k, min(lower(p_type)) AS c FROM part WHERE p_size < 3 GROUP BY 1),
x AS (SELECT p.p_partkey, p.p_name, coalesce(nullif(m.c, ''), {_PART_CASE}) AS c0
      FROM part p LEFT JOIN m ON upper(trim(p.p_name)) = m.k)
SELECT p_partkey, p_name, {q_known('c0', PART_CLASSES + PART_TYPES)} AS class FROM x""",
)
def classify_lookup_q(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part")
    mapping = unique_mapping(p.filter(F.col("p_size") < 3), "p_name", "p_type", "min")
    out = classify_lookup(p.select("p_partkey", "p_name"), "p_name", mapping, PART_CLASSES + PART_TYPES, PART_RULES)
    return out


@register(
    "unpivot_rates",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, l_shipdate, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM lineitem"
        for m in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ),
)
def unpivot_rates(spark: SparkSession, d: str) -> DataFrame:
    li = t(spark, d, "lineitem")
    return melt(li, ["l_orderkey", "l_linenumber", "l_shipdate"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "measure", "value")


# ── 2.1 / 2.3 joins and the flagship ─────────────────────────────────────────


@register("hourly_full_outer", Q_FLAGSHIP)
def hourly_full_outer_q(spark: SparkSession, d: str) -> DataFrame:
    return purchase_vs_error(spark, d)


# ── reports (2.5, 2.7, P-series) ─────────────────────────────────────────────


def _daily_avg_sql(where: str) -> str:
    cols = ", ".join(f"{q_exact_avg(c)} AS {c}" for c in EVENT_TYPES)
    return f"""
WITH f AS ({Q_PIVOT})
SELECT CAST(hour AS DATE) AS day, {cols} FROM f
WHERE {where} GROUP BY 1"""


def _daily_avg(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("hour").cast("date").alias("day")).agg(*[exact_avg(c).alias(c) for c in EVENT_TYPES])


@register("trailing_days", _daily_avg_sql("hour >= (SELECT max(hour) FROM f) - INTERVAL 7 DAY"))
def trailing_days(spark: SparkSession, d: str) -> DataFrame:
    # hour >= max(hour) - 7 days  ⇔  ts >= trunc_hour(max(ts)) - 7 days (hour-aligned bound),
    # so the window is applied to the raw rows before the hourly aggregate
    ev = t(spark, d, "events")
    recent = reports.trailing(ev, "ts", 7, anchor=reports.hour_anchor(ev, "ts"))
    return _daily_avg(hourly_pivot_of(recent))


@register("trailing_asof", _daily_avg_sql(f"hour >= TIMESTAMP '{ASOF_WALL}' - INTERVAL 7 DAY"))
def trailing_asof(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    return _daily_avg(hourly_pivot_of(reports.trailing(ev, "ts", 7, anchor=ASOF_WALL)))


@register(
    "trend_trailing",
    f"""
WITH j AS ({Q_FLAGSHIP})
SELECT hour, err_value AS co2 FROM j
WHERE hour >= (SELECT max(hour) FROM j) - INTERVAL 7 DAY AND err_value IS NOT NULL""",
)
def trend_trailing(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events").filter(F.col("event_type").isin("purchase", "error"))
    since = reports.hour_anchor(ev, "ts") - F.make_dt_interval(F.lit(7))
    j = purchase_vs_error(spark, d, since=since)
    return j.filter(F.col("err_value").isNotNull()).select("hour", F.col("err_value").alias("co2"))


@register(
    "date_range",
    """
SELECT event_id, ts, event_type, value FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-07'""",
)
def date_range(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events").select("event_id", "ts", "event_type", "value")
    return reports.clip(ev, "ts", "2024-01-05", "2024-01-07")


def _line_avgs_sql(key_expr: str, key: str) -> str:
    return f"""
SELECT {key_expr} AS {key},
  {q_round(q_exact_avg('l_quantity'), 0)} AS avg_quantity,
  {q_round(q_exact_avg('l_extendedprice'), 0)} AS avg_price,
  {q_round(q_exact_avg('l_discount'), 3)} AS avg_discount
FROM lineitem GROUP BY 1"""


def _line_avgs(spark: SparkSession, d: str, key: Column, name: str) -> DataFrame:
    li = t(spark, d, "lineitem")
    return li.groupBy(key.alias(name)).agg(
        round_half_away(exact_avg("l_quantity"), 0).alias("avg_quantity"),
        round_half_away(exact_avg("l_extendedprice"), 0).alias("avg_price"),
        round_half_away(exact_avg("l_discount"), 3).alias("avg_discount"),
    )


@register("monthly_avg", _line_avgs_sql("date_trunc('month', l_shipdate)", "month"))
def monthly_avg(spark: SparkSession, d: str) -> DataFrame:
    return _line_avgs(spark, d, trunc_ntz("month", "l_shipdate"), "month")


@register("annual_avg", _line_avgs_sql("year(l_shipdate)", "year"))
def annual_avg(spark: SparkSession, d: str) -> DataFrame:
    return _line_avgs(spark, d, F.year("l_shipdate").cast("bigint"), "year")


@register(
    "monthly_min_max",
    f"""
SELECT date_trunc('month', l_shipdate) AS month,
  {q_round(q_exact_avg('l_extendedprice'), 1)} AS avg_price,
  {q_round('min(l_extendedprice)', 1)} AS min_price,
  {q_round('max(l_extendedprice)', 1)} AS max_price
FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1""",
)
def monthly_min_max(spark: SparkSession, d: str) -> DataFrame:
    return reports.stats_by(t(spark, d, "lineitem"), "month", "l_shipdate", "l_extendedprice", "price", 1)


_ORDER_COLS = "o_orderkey, o_orderdate, o_totalprice, o_orderpriority"


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")


def _newest() -> list[Column]:
    return [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc_nulls_first()]


@register("newest_n", f"SELECT {_ORDER_COLS} FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC LIMIT 8760")
def newest_n(spark: SparkSession, d: str) -> DataFrame:
    return reports.newest_n(_orders(spark, d), _newest(), 8760)


@register("latest_snapshot", f"SELECT {_ORDER_COLS} FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC LIMIT 1")
def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return reports.newest_n(_orders(spark, d), _newest(), 1)


@register(
    "category_history",
    f"""SELECT {_ORDER_COLS} FROM orders WHERE o_orderpriority = '{URGENT}'
ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC LIMIT 90""",
)
def category_history(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d).filter(F.col("o_orderpriority") == URGENT)
    return reports.newest_n(o, _newest(), 90)


@register(
    "latest_rates",
    f"""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderpriority = '{URGENT}'
  AND o_orderdate = (SELECT max(o_orderdate) FROM orders WHERE o_orderpriority = '{URGENT}')""",
)
def latest_rates(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d)
    r = reports.latest_for_category(o, "o_orderpriority", URGENT, "o_orderdate")
    return r.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc_nulls_last(), "o_orderkey")


@register(
    "latest_rates_all",
    f"""
SELECT {_ORDER_COLS} FROM orders o
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders x WHERE x.o_orderpriority = o.o_orderpriority)""",
)
def latest_rates_all(spark: SparkSession, d: str) -> DataFrame:
    return reports.latest_per_category(_orders(spark, d), "o_orderpriority", "o_orderdate")


# ── 2.6 gaps / 2.11 quality ──────────────────────────────────────────────────


@register(
    "gaps_global",
    f"""
WITH s AS (SELECT ts AS gap_start, lead(ts) OVER (ORDER BY ts) AS gap_end
           FROM (SELECT DISTINCT ts FROM events WHERE ts IS NOT NULL))
SELECT gap_start, gap_end, {q_seconds('gap_end', 'gap_start')} AS gap_seconds FROM s
WHERE gap_end IS NOT NULL AND {q_seconds('gap_end', 'gap_start')} > 900""",
)
def gaps_global(spark: SparkSession, d: str) -> DataFrame:
    return quality.gaps(t(spark, d, "events"), "ts", 900)


@register(
    "gaps_by_key",
    f"""
WITH s AS (SELECT user_id, ts AS gap_start, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap_end
           FROM (SELECT DISTINCT user_id, ts FROM events WHERE ts IS NOT NULL))
SELECT user_id, gap_start, gap_end, {q_seconds('gap_end', 'gap_start')} AS gap_seconds FROM s
WHERE gap_end IS NOT NULL AND {q_seconds('gap_end', 'gap_start')} > 172800""",
)
def gaps_by_key(spark: SparkSession, d: str) -> DataFrame:
    return quality.gaps(t(spark, d, "events"), "ts", 172800, by=["user_id"])


@register(
    "missing_hours",
    """
WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events),
h AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS bucket FROM b)
SELECT bucket FROM h
WHERE bucket NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'purchase' AND ts IS NOT NULL)""",
)
def missing_hours(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    return quality.missing_buckets(ev.filter(F.col("event_type") == "purchase"), "ts", 3600, span=ev)


@register(
    "backfill_ranges",
    """
WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events),
h AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS bucket FROM b),
m AS (SELECT bucket FROM h
      WHERE bucket NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'purchase' AND ts IS NOT NULL)),
i AS (SELECT bucket, bucket - (row_number() OVER (ORDER BY bucket)) * INTERVAL 1 HOUR AS island FROM m)
SELECT min(bucket) AS range_start, max(bucket) AS range_end, count(*) AS buckets FROM i GROUP BY island""",
)
def backfill_ranges(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    missing = quality.missing_buckets(ev.filter(F.col("event_type") == "purchase"), "ts", 3600, span=ev)
    return quality.backfill_ranges(missing)


@register(
    "coverage",
    f"""
WITH b AS (SELECT event_type, date_trunc('hour', ts) AS b, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2),
a AS (SELECT event_type, min(b) AS first_bucket, max(b) AS last_bucket, count(*) AS buckets_found,
             CAST(sum(n) AS BIGINT) AS rows FROM b GROUP BY 1),
e AS (SELECT *, CAST({q_seconds('last_bucket', 'first_bucket')} / 3600.0 AS BIGINT) + 1 AS buckets_expected FROM a)
SELECT event_type, first_bucket, last_bucket, buckets_found, rows, buckets_expected,
  {q_round('CAST(buckets_found AS DOUBLE) / CAST(buckets_expected AS DOUBLE)', 4)} AS coverage,
  CAST(buckets_found AS DOUBLE) / CAST(buckets_expected AS DOUBLE) >= 0.95 AS complete
FROM e""",
)
def coverage_q(spark: SparkSession, d: str) -> DataFrame:
    return quality.coverage(t(spark, d, "events"), "ts", 3600, 0.95, by=["event_type"])


def _fresh_sql(source: str, table: str, col: str, thr: float) -> str:
    age = q_seconds(f"TIMESTAMP '{FRESH_ASOF}'", f"max({col})")
    return (
        f"SELECT '{source}' AS source, max({col}) AS last_update, {age} AS age_seconds, "
        f"CAST({thr} AS DOUBLE) AS threshold_seconds, coalesce({age} < CAST({thr} AS DOUBLE), false) AS is_fresh FROM {table}"
    )


@register(
    "freshness",
    " UNION ALL ".join(
        [
            _fresh_sql("readings", "events", "ts", 3600.0),
            _fresh_sql("generation", "lineitem", "l_shipdate", 86400.0),
            _fresh_sql("rates", "orders", "o_orderdate", 604800.0),
        ]
    ),
)
def freshness(spark: SparkSession, d: str) -> DataFrame:
    return quality.freshness(
        {
            "readings": (t(spark, d, "events"), "ts", 3600.0),
            "generation": (t(spark, d, "lineitem"), "l_shipdate", 86400.0),
            "rates": (t(spark, d, "orders"), "o_orderdate", 604800.0),
        },
        FRESH_ASOF,
    )


def _runs(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    return ev.select(
        F.col("user_id").alias("source"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("success")).alias("status"),
    )


@register(
    "repeat_failures",
    """
SELECT user_id AS source, count(*) AS fail_count FROM events
WHERE event_type = 'error' AND ts > (SELECT max(ts) FROM events) - INTERVAL 3 DAY
GROUP BY 1 HAVING count(*) >= 3""",
)
def repeat_failures(spark: SparkSession, d: str) -> DataFrame:
    return quality.repeat_failures(_runs(spark, d))


@register(
    "health_summary",
    f"""
SELECT user_id AS source, count(*) AS runs,
  CAST(count_if(event_type <> 'error') AS BIGINT) AS successes,
  CAST(count_if(event_type = 'error') AS BIGINT) AS failures,
  max(ts) AS last_run, max(CASE WHEN event_type <> 'error' THEN ts END) AS last_success,
  {q_round("CAST(count_if(event_type <> 'error') AS BIGINT) * 100.0 / count(*)", 1)} AS success_rate
FROM events GROUP BY 1""",
)
def health_summary(spark: SparkSession, d: str) -> DataFrame:
    return quality.health_summary(_runs(spark, d))


_NN_COLS = ["hour", "purchase_value", "n_purchases", "err_value", "err_user_id"]


def _nn_sql(with_pct: bool) -> str:
    parts = []
    for c in _NN_COLS:
        nulls = f"CAST(count_if({c} IS NULL) AS BIGINT)"
        if with_pct:
            pct = f"{nulls} * 100.0 / nullif(count(*), 0)"
            parts.append(
                f"SELECT '{c}' AS column_name, count(*) AS rows, {nulls} AS null_count, "
                f"{q_round(pct, 3)} AS null_pct, CASE WHEN {pct} > 5.0 THEN 'error' ELSE 'ok' END AS severity FROM j"
            )
        else:
            parts.append(
                f"SELECT '{c}' AS column_name, count(*) AS rows, {nulls} AS null_count, {nulls} = 0 AS passed FROM j"
            )
    return f"WITH j AS ({Q_FLAGSHIP})\n" + "\nUNION ALL ".join(parts)


@register("check_not_null", _nn_sql(False))
def check_not_null(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_not_null(purchase_vs_error(spark, d), _NN_COLS)


@register("null_share", _nn_sql(True))
def null_share(spark: SparkSession, d: str) -> DataFrame:
    return quality.null_share(purchase_vs_error(spark, d), _NN_COLS, 5.0)


@register(
    "check_unique",
    """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY 1, 2 HAVING count(*) > 1""",
)
def check_unique(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_unique(t(spark, d, "lineitem"), LINE_KEY)


_RANGES = {"value": (0.0, 300.0), "user_id": (0.0, 100.0)}


@register(
    "range_violations",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi, "
        f"CAST(count_if({c} < {lo} OR {c} > {hi}) AS BIGINT) AS violations, "
        f"CASE WHEN count_if({c} < {lo} OR {c} > {hi}) > 0 THEN 'error' ELSE 'ok' END AS severity FROM events"
        for c, (lo, hi) in _RANGES.items()
    ),
)
def range_violations(spark: SparkSession, d: str) -> DataFrame:
    return quality.range_violations(t(spark, d, "events"), _RANGES)


@register(
    "row_count_regression",
    f"""
WITH c AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
l AS (SELECT *, lag(n) OVER (PARTITION BY event_type ORDER BY day) AS prev_count FROM c)
SELECT event_type, day, n, prev_count,
  {q_round("(1.0 - CAST(n AS DOUBLE) / CAST(prev_count AS DOUBLE)) * 100.0", 2)} AS drop_pct,
  CASE WHEN n < prev_count * 0.9 THEN 'error' ELSE 'ok' END AS severity
FROM l""",
)
def row_count_regression(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    counts = ev.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return quality.row_count_regression(counts, ["event_type"], "day", "n", 0.10)


@register(
    "validation_report",
    f"""
WITH f AS ({Q_FCT}),
ns AS (
  SELECT 'null_share' AS check_name, 'clean_pct' AS subject,
    {q_round("CAST(count_if(clean_pct IS NULL) AS BIGINT) * 100.0 / count(*)", 3)} AS value FROM f),
rg AS (
  SELECT 'range' AS check_name, 'total' AS subject,
    CAST(count_if(total < 0 OR total > 30000) AS DOUBLE) AS value FROM f),
uq AS (
  SELECT 'unique' AS check_name, 'hour' AS subject, CAST(count(*) AS DOUBLE) AS value
  FROM (SELECT hour FROM f WHERE hour IS NOT NULL GROUP BY hour HAVING count(*) > 1)),
gp AS (
  SELECT 'continuity' AS check_name, 'hour' AS subject, CAST(count(*) AS DOUBLE) AS value
  FROM (SELECT hour AS a, lead(hour) OVER (ORDER BY hour) AS b FROM (SELECT DISTINCT hour FROM f WHERE hour IS NOT NULL))
  WHERE b IS NOT NULL AND {q_seconds('b', 'a')} > 7200)
SELECT check_name, subject, value, CASE WHEN value > 5 THEN 'error' ELSE 'ok' END AS severity FROM ns
UNION ALL SELECT check_name, subject, value, CASE WHEN value > 0 THEN 'error' ELSE 'ok' END FROM rg
UNION ALL SELECT check_name, subject, value, CASE WHEN value > 0 THEN 'error' ELSE 'ok' END FROM uq
UNION ALL SELECT check_name, subject, value, CASE WHEN value > 0 THEN 'warning' ELSE 'ok' END FROM gp""",
)
def validation_report(spark: SparkSession, d: str) -> DataFrame:
    f = fct_events(spark, d)
    checks = quality.keyed_checks(f, "hour", ["clean_pct"], {"total": (0.0, 30000.0)}, max_null_pct=5.0)
    return quality.validation_report(checks, quality.continuity_check(f, "hour", 7200))


# ── 2.10 incremental / streaming (batch-equal forms) ─────────────────────────


@register(
    "incremental_batch",
    f"""
WITH target AS (SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '{INCR_TARGET_BEFORE}'),
cur AS (SELECT date_trunc('month', max(o_orderdate)) AS m FROM target),
batch AS (SELECT o_orderkey, o_orderdate, o_totalprice + 1 AS o_totalprice FROM orders
          WHERE o_orderdate >= (SELECT m FROM cur))
SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
UNION ALL SELECT * FROM batch""",
)
def incremental_batch(spark: SparkSession, d: str) -> DataFrame:
    from ampere.streaming.incremental import incremental_merge

    o = t(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    target = o.filter(F.col("o_orderdate") < ts_lit(INCR_TARGET_BEFORE))
    source = o.withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0))
    return incremental_merge(target, source, "o_orderdate", ["o_orderkey"])


@register(
    "tumbling_hourly",
    f"""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS n, {q_exact_sum('value')} AS total
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2, 3""",
)
def tumbling_hourly(spark: SparkSession, d: str) -> DataFrame:
    from ampere.streaming.hourly import hourly_window_agg

    return hourly_window_agg(t(spark, d, "events"), "ts", ["event_type"], "value")


@register(
    "month_sequence",
    """
WITH b AS (SELECT l_returnflag, l_linestatus, date_trunc('month', min(l_shipdate)) AS lo,
                  date_trunc('month', max(l_shipdate)) AS hi FROM lineitem GROUP BY 1, 2),
m AS (SELECT l_returnflag, l_linestatus, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS month FROM b)
SELECT l_returnflag, l_linestatus, CAST(month AS DATE) AS month,
       CAST(month + INTERVAL 1 MONTH AS DATE) AS next_month, strftime(month, '%Y%m') || '.csv' AS file_name
FROM m""",
)
def month_sequence_q(spark: SparkSession, d: str) -> DataFrame:
    return month_sequence(t(spark, d, "lineitem"), "l_shipdate", ["l_returnflag", "l_linestatus"])


# ── projections (P1, P6–P8, S14) ─────────────────────────────────────────────


@register(
    "staged_cast",
    """
SELECT CAST(ts AS TIMESTAMP) AS ts, CAST(event_id AS VARCHAR) AS reading_id,
       coalesce(CAST(value AS DOUBLE), CAST(0 AS DOUBLE)) AS value_mw, upper(event_type) AS kind FROM events""",
)
def staged_cast(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    return ev.select(
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").cast("string").alias("reading_id"),
        F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value_mw"),
        F.upper("event_type").alias("kind"),
    )


_RENAME = {"l_orderkey": "order_id", "l_quantity": "quantity_units", "l_extendedprice": "price", "l_shipdate": "ship_ts"}


@register(
    "rename_keep",
    "SELECT l_orderkey AS order_id, l_quantity AS quantity_units, l_extendedprice AS price, l_shipdate AS ship_ts FROM lineitem",
)
def rename_keep_q(spark: SparkSession, d: str) -> DataFrame:
    return rename_keep(t(spark, d, "lineitem"), _RENAME)


@register("empty_fallback", "SELECT event_id, ts, value, CAST(NULL AS DOUBLE) AS other_mw FROM events")
def empty_fallback(spark: SparkSession, d: str) -> DataFrame:
    from ampere.sources.files import table_or_empty

    path = f"{d.rstrip('/')}/events.parquet"
    ev = table_or_empty(spark, path, None)
    return select_present(ev, ["event_id", "ts", "value", "other_mw"])


# ── pages (S11, S12, J5, F9, F10) ────────────────────────────────────────────

# The oracle has a rule of its own: a page is cut at the element's start tags, and each part
# ends at the first tag that cannot stand within the element.
_NO_CODE = r"regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'), '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g')"
_ENDS_OF = {
    "p": "</?(p|h[1-6]|div|ul|ol|li|table|section|article|nav|aside|header|footer|main|body|html|blockquote|pre|form|hr)[ >]",
    "h1": "</?h[1-6][ >]|</(article|section|div|body|html)>",
}


def _q_decoded(x: str) -> str:
    out = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for name, code in (("lt", 60), ("gt", 62), ("quot", 34), ("apos", 39), ("nbsp", 160), ("copy", 169), ("middot", 183), ("amp", 38)):
        out = f"replace({out}, '&{name};', chr({code}))"
    return out


def q_texts(tag: str) -> str:
    parts = f"(regexp_split_to_array({_NO_CODE}, '(?i)<{tag}( [^>]*)?>'))[2:]"
    return f"list_transform({parts}, lambda x: {_q_decoded(f"""regexp_replace(x, '(?is)({_ENDS_OF[tag]}).*', '')""")})"


_ITEMS = f"list_filter((regexp_split_to_array({_NO_CODE}, '(?i)<li( [^>]*)?>'))[2:], lambda x: regexp_matches(x, '(?is)^\\s*<a [^>]*href='))"
_LINK_OF = {
    1: _q_decoded("""regexp_extract(x, '(?is)^\\s*<a [^>]*href="([^"]*)"', 1)"""),
    2: _q_decoded("regexp_replace(regexp_replace(x, '(?is)^\\s*<a [^>]*>', ''), '(?is)</(a|li)>.*', '')"),
}
_LINKS = {g: f"list_transform({_ITEMS}, lambda x: {_LINK_OF[g]})" for g in (1, 2)}


_PARAS = q_texts("p")


@register(
    "html_headings",
    f"""
WITH a AS (SELECT page_id, {q_texts("h1")} AS hs FROM pages),
u AS (SELECT page_id, hs, unnest(range(len(hs))) AS i FROM a)
SELECT page_id, CAST(i AS BIGINT) AS pos, hs[i + 1] AS heading FROM u""",
)
def html_headings_q(spark: SparkSession, d: str) -> DataFrame:
    return html_headings(t(spark, d, "pages"))


@register(
    "html_list_items",
    f"""
WITH a AS (SELECT page_id, {_LINKS[1]} AS hrefs, {_LINKS[2]} AS texts FROM pages),
u AS (SELECT page_id, hrefs, texts, unnest(range(len(hrefs))) AS i FROM a)
SELECT page_id, CAST(i AS BIGINT) AS pos, hrefs[i + 1] AS href, texts[i + 1] AS text FROM u""",
)
def html_list_items_q(spark: SparkSession, d: str) -> DataFrame:
    return html_list_items(t(spark, d, "pages"))


@register(
    "zip_arrays",
    f"""
WITH a AS (SELECT page_id, {_LINKS[1]} AS hrefs, {_PARAS} AS paras FROM pages),
u AS (SELECT page_id, hrefs, paras, unnest(range(least(len(hrefs), len(paras)))) AS i FROM a)
SELECT page_id, CAST(i AS BIGINT) AS pos, hrefs[i + 1] AS href, paras[i + 1] AS para FROM u""",
)
def zip_arrays(spark: SparkSession, d: str) -> DataFrame:
    from ampere.operators.reshape import posexplode_zip

    p = t(spark, d, "pages").select(
        "page_id",
        links("html")[0].alias("hrefs"),
        element_texts("html", "p").alias("paras"),
    )
    return posexplode_zip(p, "hrefs", "paras", ["page_id"], names=("href", "para"))


@register(
    "pad_rows",
    f"""
WITH a AS (SELECT page_id, {_LINKS[2]} AS cells, len({_PARAS}) AS n FROM pages)
SELECT page_id, CAST(len(cells) + greatest(n - len(cells), 0) AS BIGINT) AS n_cells,
  CASE WHEN len(cells) = 0 THEN repeat('|', greatest(n - 1, 0))
       ELSE array_to_string(cells, '|') || repeat('|', greatest(n - len(cells), 0)) END AS joined
FROM a""",
)
def pad_rows(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "pages").select(
        "page_id",
        links("html")[1].alias("cells"),
        F.size(element_texts("html", "p")).alias("n"),
    )
    padded = pad_array("cells", F.col("n"))
    return p.select("page_id", F.size(padded).cast("bigint").alias("n_cells"), F.array_join(padded, "|").alias("joined"))


_LABELS = {
    "lang": r'<html lang="([^"]*)"',
    "title": r"<title>([^<]*)</title>",
    "ad": r'<div class="ad">([^<]*)</div>',
}


@register(
    "extract_labelled",
    f"""
SELECT page_id,
  nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang,
  nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
  nullif(regexp_extract(html, '<div class="ad">([^<]*)</div>', 1), '') AS ad,
  {q_parse_numeric(q_strip("replace(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), ''), ',', '')"))} AS page_no
FROM pages""",
)
def extract_labelled_q(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "pages")
    lab = extract_labelled(p, "html", _LABELS, keep=["page_id", "url"])
    page_no = F.nullif(F.regexp_extract("url", r"[?&]page=([0-9]+)", 1), F.lit(""))
    return lab.select("page_id", *_LABELS.keys(), parse_numeric(strip_units(page_no, [])).alias("page_no"))


# ── scalar functions on synthesised strings (F-series) ───────────────────────


def _q_chain(expr: str, subs) -> str:
    out = expr
    for a, b in subs:
        lit_a = "chr(160)" if a == "\xa0" else "chr(10)" if a == "\n" else f"'{a}'"
        out = q_strip(f"replace({out}, {lit_a}, '{b}')")
    return out


@register(
    "clean_text",
    """
WITH a AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS raw FROM pages)
SELECT page_id, raw, {h} AS header_clean, {c} AS cell_clean FROM a""".format(
        h=_q_chain("raw", [("\xa0", " "), ("\n", ""), ("   ", " "), ("*", "")]),
        c=_q_chain("raw", [("*", ""), (",", "")]),
    ),
)
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "pages").select("page_id", F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("raw"))
    return p.select("page_id", "raw", clean_header("raw").alias("header_clean"), clean_cell("raw").alias("cell_clean"))


_RAW_NUM_SQL = """CASE event_type
  WHEN 'click' THEN CAST(value AS VARCHAR)
  WHEN 'view' THEN '  ' || CAST(value AS VARCHAR) || ' '
  WHEN 'error' THEN 'N/A'
  WHEN 'signup' THEN ''
  ELSE CAST(value AS VARCHAR) || 'd' END"""
_RAW_UNITS_SQL = "CAST(user_id AS VARCHAR) || ',' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || ' MW'"


@register(
    "parse_numeric",
    f"""
WITH a AS (SELECT event_id, {_RAW_NUM_SQL} AS raw, {_RAW_UNITS_SQL} AS raw_units FROM events)
SELECT event_id, raw, {q_parse_numeric('raw')} AS parsed, raw_units,
  {q_parse_numeric(q_strip("replace(replace(raw_units, ' MW', ''), ',', '')"))} AS parsed_units
FROM a""",
)
def parse_numeric_q(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    v = F.col("value").cast("string")
    raw = (
        F.when(F.col("event_type") == "click", v)
        .when(F.col("event_type") == "view", F.concat(F.lit("  "), v, F.lit(" ")))
        .when(F.col("event_type") == "error", F.lit("N/A"))
        .when(F.col("event_type") == "signup", F.lit(""))
        .otherwise(F.concat(v, F.lit("d")))
    )
    units = F.concat(
        F.col("user_id").cast("string"), F.lit(","), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"), F.lit(" MW")
    )
    a = ev.select("event_id", raw.alias("raw"), units.alias("raw_units"))
    return a.select(
        "event_id", "raw", parse_numeric("raw").alias("parsed"), "raw_units",
        parse_numeric(strip_units("raw_units", [" MW"])).alias("parsed_units"),
    )


@register(
    "camel_to_snake",
    """
WITH a AS (SELECT event_id, event_type || 'ImportExports' || CAST(user_id AS VARCHAR) || 'MW' AS raw FROM events)
SELECT event_id, raw, lower(substr(raw, 1, 1) || regexp_replace(substr(raw, 2), '([A-Z])', '_\\1', 'g')) AS snake FROM a""",
)
def camel_to_snake_q(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    raw = F.concat("event_type", F.lit("ImportExports"), F.col("user_id").cast("string"), F.lit("MW"))
    a = ev.select("event_id", raw.alias("raw"))
    return a.select("event_id", "raw", camel_to_snake("raw").alias("snake"))


@register(
    "hour_ending",
    """
SELECT event_id, CAST(ts AS DATE) AS day, hour(ts) + 1 AS hour_ending,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + (hour(ts) + 1 - 1) * INTERVAL 1 HOUR AS hour_start FROM events""",
)
def hour_ending(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    a = ev.select("event_id", F.col("ts").cast("date").alias("day"), (F.hour("ts") + 1).cast("bigint").alias("hour_ending"))
    return a.select("event_id", "day", "hour_ending", hour_ending_to_start("day", "hour_ending").alias("hour_start"))


@register(
    "iso_format",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:00:00') AS iso_hour, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso_seconds FROM events",
)
def iso_format(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    return ev.select("event_id", iso_hour("ts").alias("iso_hour"), iso_seconds("ts").alias("iso_seconds"))


_OFFSET_SQL = """CASE event_type WHEN 'click' THEN '-05:00' WHEN 'view' THEN '-04:00'
  WHEN 'error' THEN '+01:00' WHEN 'signup' THEN 'Z' ELSE '' END"""


@register(
    "to_utc",
    f"""
WITH a AS (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || {_OFFSET_SQL} AS raw FROM events)
SELECT event_id, raw,
  CASE WHEN regexp_matches(raw, '(Z|[+-][0-9][0-9]:[0-9][0-9])$')
       THEN CAST(raw AS TIMESTAMPTZ) AT TIME ZONE 'UTC' ELSE CAST(raw AS TIMESTAMP) END AS utc_ts
FROM a""",
)
def to_utc(spark: SparkSession, d: str) -> DataFrame:
    ev = t(spark, d, "events")
    off = (
        F.when(F.col("event_type") == "click", F.lit("-05:00"))
        .when(F.col("event_type") == "view", F.lit("-04:00"))
        .when(F.col("event_type") == "error", F.lit("+01:00"))
        .when(F.col("event_type") == "signup", F.lit("Z"))
        .otherwise(F.lit(""))
    )
    a = ev.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), off).alias("raw"))
    return a.select("event_id", "raw", to_utc_naive("raw").alias("utc_ts"))


@register(
    "parse_reading_time",
    f"""
WITH a AS (SELECT o_orderkey, o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR AS t FROM orders),
b AS (SELECT o_orderkey, t,
  strftime(t, '%a %b') || CASE WHEN day(t) < 10 THEN '  ' ELSE ' ' END || CAST(day(t) AS VARCHAR) || ', '
  || strftime(t, '%-I %p') || ' - next' AS raw FROM a)
SELECT o_orderkey, raw,
  try_cast(printf('%04d-%02d-%02d %02d:00:00',
      CASE WHEN month(DATE '{READING_ASOF}') = 1 AND month(t) = 12 THEN year(DATE '{READING_ASOF}') - 1 ELSE year(DATE '{READING_ASOF}') END,
      month(t), day(t), hour(t)) AS TIMESTAMP) AS reading_ts
FROM b""",
)
def parse_reading_time_q(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders")
    ts = F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate"))
    a = o.select("o_orderkey", ts.alias("t"))
    # the label text "<Wkd> <Mon> <d>, <h> AM|PM - next", built from lookups and
    # arithmetic (same text as formatting with "EEE MMM" / "h a")
    day = F.dayofmonth("t")
    hour = F.hour("t")
    raw = F.concat(
        F.element_at(F.array(*[F.lit(x) for x in WEEKDAY_ABBR]), F.dayofweek("t")),
        F.lit(" "),
        F.element_at(F.array(*[F.lit(x) for x in MONTH_ABBR_TITLE]), F.month("t")),
        F.when(day < 10, F.lit("  ")).otherwise(F.lit(" ")),
        day.cast("string"),
        F.lit(", "),
        (((hour + 11) % 12) + 1).cast("string"),
        F.when(hour < 12, F.lit(" AM")).otherwise(F.lit(" PM")),
        F.lit(" - next"),
    )
    b = a.select("o_orderkey", raw.alias("raw"))
    return b.select("o_orderkey", "raw", parse_reading_time("raw", READING_ASOF).alias("reading_ts"))


@register(
    "parse_long_date",
    """
WITH a AS (SELECT o_orderkey, strftime(o_orderdate, '%B %-d, %Y') AS label FROM orders)
SELECT o_orderkey, label, CAST(strptime(label, '%B %-d, %Y') AS DATE) AS effective_date FROM a""",
)
def parse_long_date_q(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders")
    a = o.select("o_orderkey", F.date_format("o_orderdate", "MMMM d, yyyy").alias("label"))
    return a.select("o_orderkey", "label", parse_long_date("label").alias("effective_date"))


_SEASON_RAW_SQL = """CASE WHEN o_orderstatus = 'F'
  THEN CAST(o_custkey AS VARCHAR) || ' (Summer)  ' || CAST(o_orderkey AS VARCHAR) || ' (Winter)'
  ELSE CAST(o_custkey AS VARCHAR) END"""
_SEASON_PAT = r"(\S+) \(Summer\)\s+(\S+) \(Winter\)"


def _season_raw() -> Column:
    return F.when(
        F.col("o_orderstatus") == "F",
        F.concat(F.col("o_custkey").cast("string"), F.lit(" (Summer)  "), F.col("o_orderkey").cast("string"), F.lit(" (Winter)")),
    ).otherwise(F.col("o_custkey").cast("string"))


@register(
    "seasonal_split",
    f"""
WITH a AS (SELECT o_orderkey, {_SEASON_RAW_SQL} AS raw FROM orders)
SELECT o_orderkey, raw,
  CASE WHEN regexp_matches(raw, '{_SEASON_PAT}') THEN regexp_extract(raw, '{_SEASON_PAT}', 1) ELSE raw END AS summer,
  CASE WHEN regexp_matches(raw, '{_SEASON_PAT}') THEN regexp_extract(raw, '{_SEASON_PAT}', 2) ELSE raw END AS winter
FROM a""",
)
def seasonal_split_q(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders").select("o_orderkey", _season_raw().alias("raw"))
    s, w = seasonal_split("raw")
    return o.select("o_orderkey", "raw", s.alias("summer"), w.alias("winter"))


@register(
    "conditional_fill",
    f"""
WITH a AS (SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS higher,
  CAST(o_custkey AS VARCHAR) AS lower, {_SEASON_RAW_SQL} AS raw FROM orders),
b AS (SELECT o_orderkey, higher, lower,
  CASE WHEN regexp_matches(raw, '{_SEASON_PAT}') THEN regexp_extract(raw, '{_SEASON_PAT}', 1) ELSE raw END AS summer,
  CASE WHEN regexp_matches(raw, '{_SEASON_PAT}') THEN regexp_extract(raw, '{_SEASON_PAT}', 2) ELSE raw END AS winter FROM a)
SELECT o_orderkey,
  CASE WHEN higher = '' THEN lower ELSE higher END AS higher,
  CASE WHEN higher = '' THEN '0' ELSE summer END AS summer,
  CASE WHEN higher = '' THEN '0' ELSE winter END AS winter
FROM b""",
)
def conditional_fill_q(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderkey").cast("string")).alias("higher"),
        F.col("o_custkey").cast("string").alias("lower"),
        _season_raw().alias("raw"),
    )
    s, w = seasonal_split("raw")
    hi, s2, w2 = conditional_fill("higher", "lower", s, w)
    return o.select("o_orderkey", hi.alias("higher"), s2.alias("summer"), w2.alias("winter"))


# the composite plans (staging, marts, dashboard) register themselves on import
from ampere.plans import catalog_backfill, catalog_marts, catalog_pages  # noqa: E402,F401
