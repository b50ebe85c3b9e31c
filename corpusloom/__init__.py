"""corpusloom: a PySpark-native engine that turns document collections into clean, linked corpora."""

__version__ = "0.1.0"
