"""Training-data operators: quality, dedup, packing, mixing, formats.

Nothing outside this package imports it. Its functions are pickled by value,
so executors need numpy, pyarrow and tokenizers but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
