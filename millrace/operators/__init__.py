"""Table operators: functions that take and return DataFrames."""
