"""Operators for training-data pipelines: deduplication, scoring, tokens, search, archives and packing.

Nothing outside this subpackage imports it. Its functions travel to the executors by value, so a cluster
needs the libraries they use (numpy, pyarrow, tokenizers) but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
