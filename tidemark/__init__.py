"""tidemark: economic-indicator analytics on Spark DataFrames.

The main entry points, all ``DataFrame -> DataFrame`` with an optional entity key list:
"""

__version__ = "0.1.0"

from .operators.align import monthly_wide  # noqa: E402,F401
from .operators.dedup import latest_per_key, stage_metadata, stage_observations  # noqa: E402,F401
from .operators.load import replace_by_key, run_load, run_summary, upsert, watermarks  # noqa: E402,F401
from .operators.marts import economic_dashboard, indicator_summary  # noqa: E402,F401
from .operators.metrics import derived_metrics  # noqa: E402,F401
from .operators.signals import recession_signals, with_signals  # noqa: E402,F401
from .plans.layers import RunConfig, run_layers  # noqa: E402,F401
from .schemas import DEFAULT_SERIES, SeriesSpec, Thresholds  # noqa: E402,F401
