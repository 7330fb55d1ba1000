"""rollforge: a Spark-native engine for fixed-layout roll documents and their records."""

__version__ = "0.1.0"
