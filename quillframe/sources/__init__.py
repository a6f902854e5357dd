"""Readers: files, in-program values, JDBC."""
