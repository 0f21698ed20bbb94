"""Strandline: curation and analysis of nested scientific records on Apache Spark.

The package builds DataFrame plans only; nothing runs until the caller acts on
the returned DataFrame (operators that iterate to a fixed point say so).
"""

__version__ = "0.1.0"
