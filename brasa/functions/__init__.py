from brasa.functions.columns import (  # noqa: F401
    DEC0, DEC2, SURROGATE_NULL, avg_dec, band, clean_text, dec, flag_eq,
    indicator, pct, ratio, round_dec, safe_number, surrogate_key, trim_null,
    ts_ntz, date_lit,
)
from brasa.functions.calendar import calendar_parts  # noqa: F401
