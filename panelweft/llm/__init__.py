"""Operators for preparing training text. Nothing else in the library
imports this subpackage; it may use the library's general helpers.

Every operator takes DataFrames and returns DataFrames. A document is known by
`doc_id` and its text together: rows equal in both are one document repeated
and get equal answers. Internal columns start with two underscores.

Functions that run in Python workers travel by value, so that executors need
not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
