"""wortlab: article and loanword analytics as Spark DataFrame operators.

Sub-packages
------------
sources    readers / writers and the stand-in views over the driver tables
functions  column expressions (text, HTML, bins) - stay inside codegen
operators  DataFrame -> DataFrame operators, column names as parameters
plans      composite jobs (article builder, chart exports, cleaning, resume)
streaming  incremental jobs on Structured Streaming
"""

__all__ = ["session"]
