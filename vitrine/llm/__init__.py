"""Training-data operators: deduplication, extraction, filters, tokens and language-model scores.

Nothing outside this folder imports it. Helpers that run in Python workers are pickled by
value, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
