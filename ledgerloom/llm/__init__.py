"""Operators of a training-data pipeline; nothing outside this folder imports them.

Their task code travels with the tasks: executors need no copy of the package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
