"""logwise: log and comment stream analytics on Spark DataFrames.

Sub-packages: ``functions`` (column expressions), ``operators``
(DataFrame -> DataFrame), ``sources``, ``sinks``, ``streaming`` (Structured
Streaming queries) and ``plans`` (the two applications and the query catalog).
"""

__version__ = "0.1.0"
