"""dosewise: PySpark-native analytics for repeat-purchase (pharmacy pickup) data.

Operators are DataFrame -> DataFrame functions built from Spark SQL
expressions, windows, joins and aggregates; models are Spark ML pipelines;
streams are Structured Streaming jobs.
"""

__version__ = "0.1.0"
