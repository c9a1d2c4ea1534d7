"""Operators for large-scale training-data preparation.

Each module holds one operator built by the method its docstring names; the
registered queries (``opN_<name>`` and ``pipeline``) are thin wrappers in
:mod:`tierone.llm.queries`. Nothing outside this subpackage imports it.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run in executors travel by value: workers need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
