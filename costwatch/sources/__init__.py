"""Readers, writers and the mapping of the benchmark tables to the input tables."""
