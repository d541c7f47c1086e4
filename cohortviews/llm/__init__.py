"""Operators for preparing training text and embeddings at scale; nothing else in the library imports them.

Functions that run inside tasks travel with the job, so executors need numpy, pyarrow and the libraries that an
operator names, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
