"""Operators for preparing training data: deduplication, packing, quality, language, privacy, URLs, models.

Nothing else in the library imports this package. Its Python functions travel to the
executors by value, so the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
