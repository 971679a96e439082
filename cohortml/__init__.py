"""cohortml: supervised feature discovery on Spark DataFrames."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python functions shipped to executors (pandas UDFs, grouped functions) are
# pickled by value, so workers need no copy of this package on their path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__version__ = "0.1.0"
