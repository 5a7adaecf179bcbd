"""All check queries."""

from checks import (  # noqa: F401
    q_aggregates,
    q_forecast_metrics,
    q_joins,
    q_models,
    q_shape_splits,
    q_sources_rows,
    q_templates,
    q_windows,
)
