"""Cleaning, profiling and segmentation of sales lines as Spark DataFrame operators."""
