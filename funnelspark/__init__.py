"""Screening funnels and analytics over DataFrames."""
