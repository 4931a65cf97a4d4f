from wayfare.sources.readers import (  # noqa: F401
    scan_events,
    scan_lookup,
    scan_raw_csv,
    scan_recommendations,
    stream_payloads,
)
from wayfare.sources.fixtures import (  # noqa: F401
    load_table,
    lookup_from_nation,
    events_from_event_log,
    events_from_orders,
    raw_rows_from_event_log,
)
