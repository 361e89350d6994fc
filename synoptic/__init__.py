"""synoptic: a Spark-native engine for linking records across heterogeneous catalogues."""

__version__ = "0.1.0"
