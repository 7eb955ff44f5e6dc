"""Structured Streaming: the same record plan on files that keep arriving."""

import sys

from pyspark import cloudpickle

# What tasks run of this package goes along with them: workers need not find it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
