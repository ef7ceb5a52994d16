"""Scalar Column expressions (section 2.9 of the survey)."""

from ampere.functions.classify import FUEL_RULES, classify, name_key, to_known_class
from ampere.functions.numeric import (
    NUMBER_PATTERN,
    blank_to_null,
    coalesce0,
    exact_avg,
    exact_sum,
    parse_numeric,
    round_half_away,
    share_pct,
    strip_units,
)
from ampere.functions.text import (
    camel_to_snake,
    clean_cell,
    clean_header,
    conditional_fill,
    normalize_header_name,
    pad_array,
    replace_chain,
    seasonal_split,
    zip_shortest,
)
from ampere.functions.time import (
    calendar_columns,
    epoch_ms,
    hour_ending_to_start,
    iso_hour,
    iso_seconds,
    localize,
    next_month_start,
    parse_long_date,
    parse_reading_time,
    seconds_between,
    to_ntz,
    to_utc_naive,
    trunc_ntz,
)

__all__ = [name for name in dir() if not name.startswith("_")]
