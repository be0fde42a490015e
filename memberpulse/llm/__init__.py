"""Operators of a training-data pipeline: dedup, scoring, decontamination, packing, archives.

Nothing else in the library imports this subpackage; it uses the library's
general helpers only (``memberpulse.session``).
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so a job needs no copy of the library there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
