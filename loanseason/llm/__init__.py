"""Operations of a training-data pipeline. Nothing outside this folder imports it.

Functions of this folder travel to Python workers by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
