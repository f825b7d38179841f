"""Operators that prepare text for training, on whole corpora.

The functions that run inside tasks travel with the plan, so that executors do
not need this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
