"""cvelake: vulnerability-intelligence tables on Spark.

Bronze (raw feed rows) -> Silver (parsed, deduplicated, quality-checked) ->
Gold (risk-scored analytics), plus similarity search, batch question
routing, dashboard datasets and change feeds. Every step is a function
from DataFrames to DataFrames built from Spark built-ins only.
"""

from cvelake.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
