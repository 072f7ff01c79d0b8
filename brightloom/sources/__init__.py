"""Readers, writers and the input views of the queries."""
