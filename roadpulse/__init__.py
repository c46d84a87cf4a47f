"""roadpulse: vehicle-telemetry analytics on Spark DataFrames.

Five JSON feeds (vehicle, gps, traffic camera, weather, emergency) are decoded with
Structured Streaming, kept as raw Parquet, cleaned and enriched into date-partitioned
tables and queried with plain DataFrame functions.
"""

from roadpulse.schemas import FEEDS, FEED_SCHEMAS  # noqa: F401
from roadpulse.session import build_session, scratch_dir  # noqa: F401
