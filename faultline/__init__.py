"""Seismic event streams, station readings and sites as Spark DataFrames."""
