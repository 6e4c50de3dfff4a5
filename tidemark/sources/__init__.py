"""Readers: topics, delimited lines, JDBC, wide-column cells, catalog tables."""
