"""Readers: INSERT dumps, monthly invoice files, staged legs, benchmark legs."""
