"""Operators of a training-data pipeline, each as a function from DataFrame to DataFrame."""
