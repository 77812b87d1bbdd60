"""faultline: Spark-native SLA and ticket-demand analytics.

Every operator is a DataFrame -> DataFrame function built on Spark SQL
expressions and ``pyspark.ml``; nothing holds a global session.
"""

__version__ = "0.1.0"
