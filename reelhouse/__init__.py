"""Rental and auction analytics as plain functions from DataFrames to DataFrames."""
