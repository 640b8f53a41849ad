"""Operators for preparing training text. Nothing outside this subpackage imports it.

Functions of this subpackage that run inside tasks are shipped with the tasks, so that executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
