from wayfare.functions.scalar import (  # noqa: F401
    as_ntz_literal,
    day_of,
    day_window,
    days_since_epoch,
    epoch_millis_of,
    holdout_key,
    iso_text_to_utc,
    lookback_cutoff,
    millis_to_utc,
    parse_int_strict,
    status_weight,
    utc_now,
    utc_to_zone,
)
