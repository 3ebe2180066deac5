"""Training-data operators. Nothing else in the library imports this package.

Kernel modules (NumPy code that runs inside tasks) are pickled by value, so
executors need this repository neither installed nor on their path.
"""

import sys

from pyspark import cloudpickle

from . import features as _features
from . import kernels as _kernels
from . import matching as _matching
from . import mixture as _mixture
from . import trie as _trie
from . import variants as _variants

for _m in (_features, _kernels, _matching, _mixture, _trie, _variants):
    cloudpickle.register_pickle_by_value(sys.modules[_m.__name__])
