"""Operators for training-data pipelines (documents in, documents or findings out).

Each module holds one operator with its own general interface; ``queries``
registers the production runs. Nothing else in the library imports this
subpackage.
"""

import sys

from pyspark import cloudpickle

# functions run in tasks travel by value: the workers need not import this repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])
