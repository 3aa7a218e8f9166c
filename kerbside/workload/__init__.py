"""Mobility tables derived from the given parquet tables, the registered queries over them, and
the SQL each query is checked against."""
