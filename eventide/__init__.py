"""eventide: event-analytics operators on Spark DataFrames."""
