"""Operators for preparing training data: search, sharding, mixing, scanning, packing, archives.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Python workers get this code with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
