"""airshed: Spark-native air-quality analytics.

Raw pollution feeds are staged, unified and classified, aggregated by day and hour,
ranked by month, scanned for seasonal / hourly / weekday patterns, scored forecast
against actual, and checked for quality. Every operator is a DataFrame -> DataFrame
function built from pyspark.sql.functions, so Catalyst plans the whole chain.
"""

__version__ = "0.1.0"
