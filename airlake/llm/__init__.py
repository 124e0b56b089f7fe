"""Operators a training-data pipeline needs, each by one named method."""
