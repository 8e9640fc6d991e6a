"""Change-data-capture, lake maintenance, quality and run-metric operators for PySpark."""

__version__ = "0.1.0"
