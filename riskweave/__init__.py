"""riskweave — entity-risk analytics as Spark DataFrame operators.

Every public operator takes DataFrames (plus plain parameters) and returns a
DataFrame; execution is left to Catalyst/Tungsten.  Sub-packages:

* ``sources``   declared schemas, readers, writers, run manifest
* ``functions`` column expressions (ratios, rounding, flags, banding, text)
* ``operators`` DataFrame -> DataFrame building blocks (aggregates, profile,
                 risk scoring, indicators, exploration, data quality)
* ``plans``     adapters from the driver tables to entity roles, the
                 registered queries and the end-to-end publish run
* ``streaming`` notes on incremental refresh (the reference is batch only)
"""

__version__ = "0.1.0"
