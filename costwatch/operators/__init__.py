"""Operators. Every function takes and returns `DataFrame`s and runs no action,
except where its text says that it stages a table or enforces a check."""
