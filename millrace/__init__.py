"""millrace: data preparation and analytics as plain functions on Spark DataFrames."""
