"""readloom: a PySpark-native read quantification and table-processing engine."""

__version__ = "0.1.0"
