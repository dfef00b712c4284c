"""medalyst: medallion tables and business analytics as plain Spark jobs."""

__version__ = "0.1.0"
