"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

from pyspark import cloudpickle

import sessionrank

# Executors get the code of Python tasks with the tasks, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sessionrank)
