"""One model per group of rows, fitted, tuned and scored for all groups at once on Spark."""

import sys

from pyspark import cloudpickle

# Executors need no installed copy: task functions travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
