"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage.  Functions that run on
the executors are pickled by value, so the executors need the public
libraries (numpy, pyarrow, tokenizers) but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
