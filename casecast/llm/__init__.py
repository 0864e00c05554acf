"""Operations of a training-data pipeline over documents, embeddings and conversations."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel whole, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
