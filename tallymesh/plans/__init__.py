"""Whole runs, staged tables and shipping."""
