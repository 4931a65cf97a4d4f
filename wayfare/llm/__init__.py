"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Its functions travel to executors
by value, so executors need only the third-party libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
