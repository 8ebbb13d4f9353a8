"""shelfwatch: retail price capture, warehousing and analytics on Spark DataFrames.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects (or
Columns); nothing is collected to the driver inside an operator.
"""

__version__ = "0.1.0"
