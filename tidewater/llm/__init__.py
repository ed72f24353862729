"""Training-data operators; nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel by value: executors need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
