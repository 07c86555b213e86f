"""Flight-fare medallion pipeline (landing, bronze, silver, gold, report) on Spark DataFrames."""
