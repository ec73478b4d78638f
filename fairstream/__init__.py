"""Fair clustering, heavy hitters and word statistics as lazy Spark DataFrame operators."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# the few Arrow helpers travel inside the job, so executors need no copy of this package
register_pickle_by_value(sys.modules[__name__])
