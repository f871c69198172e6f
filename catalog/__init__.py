"""The operators over the test tables, each next to the SQL it must equal."""

import sys

from pyspark import cloudpickle

# models defined here travel to the executors as code, wherever the driver was started
cloudpickle.register_pickle_by_value(sys.modules[__name__])
