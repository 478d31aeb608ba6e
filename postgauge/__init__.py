"""Post-quality analytics for Q&A collections, expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

# Small helper functions travel to the executors with the tasks that use them, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
