"""Reusable DataFrame operators: series windows, quantiles, pivots, metrics."""
