"""Operators that prepare text for language models.

Nothing else in the library imports this package.  Functions that run on the
executors are sent there by value, so the package need not be installed on them.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
