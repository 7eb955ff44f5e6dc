"""Operators for preparing training data; nothing else in the library imports this package.

The functions that run in Python workers travel with the job by value, so executors need this
package's third-party libraries but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
