"""Airline offer, booking and ancillary-revenue analytics on Spark DataFrames."""
