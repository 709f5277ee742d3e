"""Compositions of operators, the query catalogue and its check SQL."""
