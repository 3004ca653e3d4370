"""Peer-adjusted benchmarking of large record tables with Spark DataFrames."""
