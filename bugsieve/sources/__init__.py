"""Sources: readers that turn files, text columns and work items into staging frames."""

import sys

from pyspark import cloudpickle

# What tasks run of this package goes along with them: workers need not find it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
