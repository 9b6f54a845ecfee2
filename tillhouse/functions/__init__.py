from .dates import day_name, iso_weekday, month_name, time_key
from .json_text import explode_json_array, field, unreadable
from .money import as_money, from_cents, money_sum, percent_change, ratio, rounded_quotient, share_cents, to_cents
from .ordering import pg_asc, pg_desc
from .predicates import all_of, half_years, optional_equal, within_days
from .text import as_number, contains_any, hour_label, is_email, is_not_negative, is_whole_number, js_trim, strip_angle_brackets

__all__ = [
    "all_of",
    "as_money",
    "as_number",
    "contains_any",
    "day_name",
    "explode_json_array",
    "field",
    "from_cents",
    "half_years",
    "hour_label",
    "is_email",
    "is_not_negative",
    "is_whole_number",
    "iso_weekday",
    "js_trim",
    "money_sum",
    "month_name",
    "optional_equal",
    "percent_change",
    "pg_asc",
    "pg_desc",
    "ratio",
    "rounded_quotient",
    "share_cents",
    "strip_angle_brackets",
    "time_key",
    "to_cents",
    "unreadable",
    "within_days",
]
