"""Operators for preparing training corpora, one module per operator.

Nothing else in the package imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the executors with the jobs that use
# them, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
