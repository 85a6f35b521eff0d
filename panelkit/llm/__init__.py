"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` derives the registered
``opN_<name>`` results from them.

Tasks carry the operators' code with them (pickled by value), so executors need
only the third-party libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
