"""A PySpark-native engine for colour-space reads and genomic intervals."""

__version__ = "0.1.0"
