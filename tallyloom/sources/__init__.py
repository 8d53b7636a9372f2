"""Readers and writers: text, delimited, JSON, CSV, vectors, JDBC and keyed snapshot tables."""
