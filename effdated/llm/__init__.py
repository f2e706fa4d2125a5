"""Training-data operators: dedup, extraction, language, secrets, URLs, quality, mixing, packing.

Nothing else in the library imports this package. Each module holds one operator with
a general interface; ``registry.py`` holds the thin queries over the driver's tables.
"""

import sys

from pyspark import cloudpickle

# Python tasks carry this package's functions by value: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
