"""shelfcast: retail panel time-series analytics as lazy Spark DataFrame operators.

Layout
------
sources/    typed scans, sinks and the fixture views over the driver tables
functions/  column-expression helpers (calendar, guarded ratios, small scalar math)
operators/  DataFrame -> DataFrame operators (quality, panel, windows, joins,
            aggregates, reshape, encoders, time series, tests, evaluation, models)
plans/      composite feature / split / forecast jobs built from operators
streaming/  incremental (micro-batch) form of the panel feature job
catalog/    the registered queries (Spark callable + DuckDB oracle SQL)
"""

from shelfcast.spec import PanelSpec, SplitSpec, DEFAULT_PANEL, DEFAULT_SPLIT

__all__ = ["PanelSpec", "SplitSpec", "DEFAULT_PANEL", "DEFAULT_SPLIT"]
