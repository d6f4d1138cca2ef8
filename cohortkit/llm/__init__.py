"""Training-data operators: quality, WARC, fingerprints, secrets, toxicity, near-dedup, chat, packing.

Nothing outside this folder imports it; the entry module adds its queries only when it is present.
Functions that run in Python workers travel by value, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
