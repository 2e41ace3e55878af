"""Version-controlled, provenance-preserving analytics over structured documents, as DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so that no executor needs this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
