"""innsight: listing resolution and review analytics as Spark DataFrame jobs.

Sub-packages
------------
functions   Column -> Column helpers (text keys, parsing, review cleaning)
operators   DataFrame -> DataFrame operators (resolve, reviews, extract, incremental)
sources     table scans and sinks
streaming   Structured Streaming forms of the incremental operators
plans       bindings of the operators to the driver test tables, and the query registry
"""

__all__ = ["session"]
