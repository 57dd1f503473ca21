"""Layered (bronze, silver, gold) analytics tables on Spark DataFrames."""
