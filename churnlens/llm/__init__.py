"""Training-data operators: formatting, dedup, joins, tokens, mixing, scoring."""

import sys

from pyspark import cloudpickle

# task functions travel whole, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
