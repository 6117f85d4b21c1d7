"""Operators on long tables: counts, points, neighbours, edges, labels."""
