"""Operators that prepare training text from a corpus of documents."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with their tasks: executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
