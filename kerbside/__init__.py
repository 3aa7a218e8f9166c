"""kerbside: urban-mobility analytics as plain Spark jobs.

Every public function takes and returns DataFrames or Columns, so the same
definitions run in batch, in Structured Streaming, on a laptop and on a cluster.
"""
