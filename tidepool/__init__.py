"""tidepool: keyed stream and batch operators on Spark DataFrames.

Every operator takes and returns a DataFrame; batch and streaming inputs share
one function wherever Structured Streaming allows the same plan.
"""

from tidepool.session import checkpoint_dir, local_session

__all__ = ["checkpoint_dir", "local_session"]
