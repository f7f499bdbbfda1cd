"""Column functions. All are built-in Spark expressions; none runs Python per row."""

from crewlens.functions.clock import (
    in_local_years,
    local_date,
    local_year_from,
    minutes_between,
    parse_clock,
    parse_ts,
    to_local,
    today_utc,
    utc_year_bounds,
)
from crewlens.functions.columns import (
    hours_from_minutes,
    json_value,
    money,
    optional_column,
    typed_null,
)
from crewlens.functions.text import clean_text, join_text, labelled, labelled_list, utrim

__all__ = [
    "clean_text",
    "hours_from_minutes",
    "in_local_years",
    "join_text",
    "json_value",
    "labelled",
    "labelled_list",
    "local_date",
    "local_year_from",
    "minutes_between",
    "money",
    "optional_column",
    "parse_clock",
    "parse_ts",
    "to_local",
    "today_utc",
    "typed_null",
    "utc_year_bounds",
    "utrim",
]
