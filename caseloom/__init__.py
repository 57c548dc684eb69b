"""DataFrame operators and models for administrative case data on PySpark."""

__version__ = "0.1.0"
