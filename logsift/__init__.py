"""logsift: log-quality and anomaly analytics on Spark DataFrames.

Every operator is a function from DataFrame(s)/Column(s) to a DataFrame or
Column, so Catalyst plans the whole job.  Drivers only ever collect bounded
metadata (at most one row per column, per null pattern or per bucket).
"""

import sys

from pyspark import cloudpickle

from logsift.session import get_spark, ensure_session_defaults, checkpoint_dir

__all__ = ["get_spark", "ensure_session_defaults", "checkpoint_dir"]

# Functions that run in Python workers travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
