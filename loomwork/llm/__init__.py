"""Operators of training-data pipelines: one module per operator, named queries in ``queries``."""
