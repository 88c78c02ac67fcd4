"""Operators for training-data pipelines over a ``documents`` table.

Each module holds one operator with its general interface; ``queries``
registers the thin ``opN_<name>`` queries and ``oracle_sql`` their DuckDB
twins.  Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors whole, which then need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
