"""Telemetry events to sessions, on tables and on streams, with plain Spark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# State functions travel to the executors with the query: nothing has to be installed there.
register_pickle_by_value(sys.modules[__name__])
