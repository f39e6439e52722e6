from pulseframe.functions.columns import blank_as_null, c, is_missing, percent, sprintf
from pulseframe.functions.keys import CALENDAR_MONTHS, CALENDAR_WEEKS, month_key, month_label, week_start
from pulseframe.functions.joins import BROADCAST_BYTES, attach, fits_broadcast, join_split

__all__ = [
    "BROADCAST_BYTES", "CALENDAR_MONTHS", "CALENDAR_WEEKS", "attach", "blank_as_null", "c", "fits_broadcast",
    "is_missing", "join_split", "month_key", "month_label", "percent", "sprintf", "week_start",
]
