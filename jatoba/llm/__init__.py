"""Operators of a training-data pipeline, each by one named method, and their registered queries."""
