"""Point-in-time (bitemporal) analytics as ordinary Spark DataFrame jobs.

Every row carries the interval it describes and the moment it became knowable, so
"as known at 20:00 yesterday" is a filter.  Sub-packages:

``functions``  column expressions (trading day, provenance, derived measures)
``sources``    scans, report parsing, archive unpacking
``operators``  DataFrame -> DataFrame building blocks
``plans``      the composite results (feature table, quality report, splits)
``streaming``  the same results fed by Structured Streaming
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run on executors travel with their code, so a cluster needs no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
