"""Composite plans: warehouse, marts, quality, features, models, anomalies, served queries."""
