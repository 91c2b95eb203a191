"""citemill: prepare documents for retrieval and search them, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Send the few Python functions that run in tasks along with the task, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
