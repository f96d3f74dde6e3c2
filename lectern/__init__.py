"""Corpus pipelines and retrieval as Spark DataFrame programs."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code along, so executors do not need this package
# installed and a job runs from any folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
