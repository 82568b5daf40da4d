"""Spark-native analytics for a local-news web archive.

Every operator is a function DataFrame -> DataFrame (or Column -> Column)
built on Spark SQL built-ins; see README.md for the map of modules.
"""

__version__ = "0.1.0"
