"""Operators that prepare text for training language models.

Nothing outside this package imports it.  Functions that run inside tasks are
sent to the executors by value, so a cluster needs no installation of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
