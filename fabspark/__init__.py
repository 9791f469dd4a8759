"""Die-map inspection and process-quality analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Arrow kernels travel to executors inside the task closure, so a cluster needs no
# separate copy of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
