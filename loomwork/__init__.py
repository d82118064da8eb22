"""Spark jobs for fine-tuning data, run logs, predictions and the run registry."""
