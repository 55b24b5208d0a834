"""Ready-made analyses: functions from DataFrames to a lazy DataFrame."""
