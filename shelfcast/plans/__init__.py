"""Composite jobs (feature tables, splits, horizon features, forecasts, reports)."""
