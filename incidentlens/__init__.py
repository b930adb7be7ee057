"""Spark-native analytics for geolocated incident records.

Delivered CSV files are typed and validated, kept as partitioned Parquet,
filtered by area, binned into hexagons and summarised per precinct, month and
cell. Every function takes and returns DataFrames or Columns; nothing runs
outside Spark SQL.
"""
