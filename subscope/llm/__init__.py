"""Operators for preparing training text: filters, joins, models and encoders on Spark."""
