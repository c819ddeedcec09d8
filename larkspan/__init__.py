"""larkspan: text, retrieval, graph and business analytics as Spark jobs."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run in Python workers travel with the job, so executors need
# neither an installed copy of this package nor its folder on their path.
register_pickle_by_value(sys.modules[__name__])
