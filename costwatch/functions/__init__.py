"""Column expressions. Every function takes and returns `Column`s."""
