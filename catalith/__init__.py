"""Catalog enrichment, matching and data-quality operators for PySpark.

Everything here is ``DataFrame -> DataFrame`` or ``Column -> Column``: Spark plans, partitions and shuffles the work.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Arrow functions travel inside the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
