"""auditmill: code-risk auditing of large artifact tables as PySpark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# The few Python workers (syntax-tree scan, archive fan-out) are shipped by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "1.0.0"
