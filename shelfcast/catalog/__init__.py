"""Registered queries, one module per area. Importing this package fills the registry."""

from shelfcast.catalog import aggregates, backtests, external, flagship, holidays, models, pipelines, quality, reports, scans, series, windows  # noqa: F401
