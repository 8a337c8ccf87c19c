"""finflow: composable PySpark operators for transaction analytics, on tables and streams."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: its Python functions travel whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
