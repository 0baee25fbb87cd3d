"""The workshop's datasets as functions from DataFrames to DataFrames, plus
runners that move them through bronze/silver/gold storage."""
