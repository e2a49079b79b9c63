from cartwheel.functions.calendar import (  # noqa: F401
    days_between, iso_week, month_number, next_week, to_timestamp_strict, week_start,
    week_start_ts, yyyymmdd,
)
from cartwheel.functions.keys import hash_after, hash_bucket, hash_lead, hash_long, hash_order  # noqa: F401
from cartwheel.functions.lists import backfill, joined, take_first  # noqa: F401
from cartwheel.functions.numeric import (  # noqa: F401
    degradation_pct, nan_to_null, round_half_even,
)
