"""Hard-negative mining for retrieval training sets as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# The functions handed to Python workers travel with the task, so executors need
# not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
