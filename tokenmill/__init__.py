"""Corpus preparation, instruction data, evaluation and run metrics as Spark jobs."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# task functions travel whole, so executors need not have this package installed
register_pickle_by_value(sys.modules[__name__])
