"""Customer results for retail loyalty data, expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
