"""Compositions of operators: extraction, training, scoring."""
