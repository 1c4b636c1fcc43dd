"""Training-data operators: deduplication, quality rules, mixing, packing, extraction, sharding.

Nothing else in the package imports this folder. Each module holds one operator with a general
interface over DataFrames; ``queries`` applies them to the given tables.

Functions that run in Python workers are shipped by value, so executors need numpy, pandas,
pyarrow and xxhash but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
