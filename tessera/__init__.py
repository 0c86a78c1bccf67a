"""tessera: profiling, feature, text, model and stream operators as Spark DataFrame plans.

Every operator is a function from DataFrame(s) to a DataFrame (or an ML Pipeline / a
Structured Streaming query), so Catalyst plans it and it runs wherever the session runs.
"""

__version__ = "0.1.0"

# Functions shipped to Python workers (Pandas UDFs, mapInPandas) are pickled by value, so
# executors need no copy of this package on their path.
import sys as _sys  # noqa: E402

from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
