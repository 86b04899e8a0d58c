"""Reads: SQL, JDBC, files, ranges of a key, and everything past a cursor."""
