"""Training-data operators: thirteen corpus operators and their registered queries.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package go to the executors by value, so that nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
