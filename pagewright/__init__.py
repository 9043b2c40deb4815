"""pagewright: Spark-native rebuilding, cleaning and auditing of page-oriented report text."""

__version__ = "0.1.0"
