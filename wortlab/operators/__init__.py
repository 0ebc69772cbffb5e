"""DataFrame -> DataFrame operators.  Column names are parameters, so the
same operator runs on the article table and on the TPC-H-ish tables."""
