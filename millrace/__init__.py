"""millrace: a Spark-native engine for collecting, cleaning, ranking and auditing web articles."""

__version__ = "0.1.0"
