"""Whole jobs built from the operators; the only place that starts writes."""
