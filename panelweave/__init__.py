"""Gap filling for (entity, indicator, period) panels as Spark jobs.

The canonical table is long: ``panel(entity, indicator, period, value)``.
A missing cell is an absent row, so every operator's work grows with the
observed data and only exports are ever wide.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the plan, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
