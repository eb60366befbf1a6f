"""Predictive-maintenance analytics for machine fleets on Spark DataFrames."""
