from rotorwatch.functions.columns import (  # noqa: F401
    adjusted_time,
    alert_id,
    alert_reason,
    any_null,
    finite_or_null,
    first_present,
    fixed_decimals,
    health_status,
    reading_anomaly,
    safe_timestamp,
    shifted_event_time,
    status_label,
)
from rotorwatch.functions.exact import partial_means, whole_mean  # noqa: F401
