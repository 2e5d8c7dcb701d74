from strata.functions.columns import (  # noqa: F401
    json_map,
    pick,
    safe_rate,
    strip_frame,
    to_event_time,
)
