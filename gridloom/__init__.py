"""gridloom: a Spark-native engine for gridded survey imagery, labels and corpora."""

__version__ = "0.1.0"
