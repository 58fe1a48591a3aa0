"""Column expressions shared by the sources and operators. No Python row functions."""
