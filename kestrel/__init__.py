"""kestrel: Spark-native toolkit for profiling, preparing and evaluating
tabular binary-classification data.

Every operator takes and returns a ``pyspark.sql.DataFrame`` (or a fitted
``pyspark.ml`` stage); no operator collects row data to the driver.
"""

__version__ = "0.1.0"
