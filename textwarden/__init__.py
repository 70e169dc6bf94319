"""Content screening for tables and streams of text on Spark."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to executors with the job, so a cluster needs
# no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
