"""Music-chart warehouse and query catalogue on Spark DataFrames."""
