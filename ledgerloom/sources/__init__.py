"""Readers, generators of rows and the binding to the test tables."""
