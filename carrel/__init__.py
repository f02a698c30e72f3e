"""carrel: record reconciliation, search and corpus operators on PySpark DataFrames."""
