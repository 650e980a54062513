"""Operators that prepare text corpora for language-model training."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the tasks that call them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
