"""Option-quote filtering and volatility-index analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

from quotelake.config import EngineConfig

# Functions that run in Python workers travel with the task, so executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["EngineConfig"]
