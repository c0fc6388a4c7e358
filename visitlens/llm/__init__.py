"""Operators for training-data corpora (documents, web pages, archives).

Functions that run inside tasks are shipped by value, so executors need
numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
