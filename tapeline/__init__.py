"""tapeline: panel analytics (one row per instrument and day) and tick processing on Spark."""

import sys

from pyspark import cloudpickle

from tapeline.session import spark_session
from tapeline.staging import shared_dir, stage

# Functions that run inside tasks travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["shared_dir", "spark_session", "stage"]
