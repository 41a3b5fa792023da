"""marketlens: Spark-native analytics over panels of market time series.

Every public operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql`` expressions; the only Python on the hot path is a few
Arrow-batched pandas UDFs where Spark has no equivalent (text-model scoring,
isolation-forest scoring).
"""

from marketlens.functions.panel import Panel, nan_to_null, sdiv

__all__ = ["Panel", "nan_to_null", "sdiv"]
__version__ = "0.1.0"
