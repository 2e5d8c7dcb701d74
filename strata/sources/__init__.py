from strata.sources.fixture import broker_messages, raw_events, saas_events  # noqa: F401
from strata.sources.tables import (  # noqa: F401
    read_event_stream,
    read_silver_events,
    read_stage,
    read_table,
    read_table_stream,
    stage_files,
)
