"""Time-series sensor quality control and alignment on Spark DataFrames."""
