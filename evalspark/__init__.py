"""Instruction-data preparation and model-output evaluation as Spark jobs.

``functions``  Column -> Column expressions (text, JSON, token helpers)
``operators``  DataFrame -> DataFrame steps (scoring, splits, judging, reports)
``sources``    JSON Lines and CSV readers and writers
``plans``      end-to-end jobs put together from the operators
``workload``   the registered queries over the driver's tables and their SQL twins
"""

import sys

from pyspark import cloudpickle

from evalspark.session import prepare

# Task functions travel with the query, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["prepare"]
