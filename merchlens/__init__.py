"""Product recommendation on Spark: statistics, factor models, similarity and online re-ranking."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
