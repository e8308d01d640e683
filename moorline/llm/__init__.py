"""Operators of a training-data pipeline: licence and secret scans, decontamination,
WARC, near and exact deduplication, packing, sharding, language ID and sanitisation.

Every operator is a ``DataFrame -> DataFrame`` function with its own general
interface; ``queries`` holds the thin registered queries.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
