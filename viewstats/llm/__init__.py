"""Operators for preparing language-model training data, one module each, and their queries."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package with the job, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
