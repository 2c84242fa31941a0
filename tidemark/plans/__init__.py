"""Physical-plan helpers: how per-symbol series are split across tasks."""

from tidemark.plans.partitioning import (  # noqa: F401
    Series,
    index_rows,
    over_series,
    running_totals,
    spread_halo,
)
