"""Whole jobs built from the operators: algorithm comparison, size sweep, query catalogue."""
