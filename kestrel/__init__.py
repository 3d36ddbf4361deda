"""kestrel: transaction-risk analytics as Spark DataFrame / SQL / ML / Streaming jobs.

Every public function takes and returns DataFrames (or small driver-side
scalars such as a fitted statistic) and keeps the row-level work on Spark.
"""

__version__ = "0.1.0"
