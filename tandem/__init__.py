"""Failover-aware lookup enrichment on Spark, and the analytics of its lookup log."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel whole, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
