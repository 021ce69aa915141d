"""Operators of a training-data pipeline over a table of documents."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors with the job, so that they need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
