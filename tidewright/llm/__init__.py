"""Operators of a training-data pipeline.

Functions that run on executors travel with the job, so that executors need no
copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
