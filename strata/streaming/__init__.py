from strata.streaming.jobs import (  # noqa: F401
    SilverPaths,
    read_dlq,
    read_events,
    read_gold,
    read_late,
    read_plan_events,
    read_sessions,
    read_users,
    run_to_completion,
    start_bronze,
    start_silver,
    start_sessions,
    StreamStatus,
)
