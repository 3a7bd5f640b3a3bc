"""Operators for preparing training text: scans, joins, extraction, scoring, mixing, sharding.

Each operator takes DataFrames and returns DataFrames. It reads only the columns it names, so
extra columns, whatever they are called, neither disturb it nor reach its result (operators that
give documents back keep them). Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
