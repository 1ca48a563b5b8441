"""Training-data operators: toxicity, chat formatting, deduplication, encoding, search, WARC, packing.

Nothing else in the library imports this subpackage.  Operators take and
return DataFrames; :mod:`riskweave.llm.queries` applies each of them to its
whole table for the driver.

Functions of this package travel to the executors by value, so workers need
no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
