"""Operators for training-data pipelines; the driver's queries over them are in ``queries``."""
