"""External-series and store features (F-04, F-05, E-03, E-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


from shelfcast.operators.encoders import frequency_encode, label_mapping
from shelfcast.operators.panel import complete_panel, ffill_bfill
from shelfcast.operators.windows import lag_col, pct_change, rolling_col
from shelfcast.spec import PanelSpec

# Feature names.
OIL_FEATURES = ["oil_price", "oil_price_lag_7", "oil_price_lag_14", "oil_price_rolling_mean_28", "oil_price_change_pct"]
# Feature names.
STORE_FEATURES = ["type", "city", "state", "cluster", "store_type_enc", "city_freq", "state_freq", "store_type_encoded"]


def oil_daily(oil: DataFrame, end=None, value: str = "dcoilwtico") -> DataFrame:
    """Daily oil table from first quote to `end` (default last quote): filled, lagged, rolled.

    One row per calendar day; all windows run over this small date table only.
    """
    spec = PanelSpec(keys=(), target="oil_price")
    grid = complete_panel(oil.select("date", F.col(value).alias("oil_price")), spec, flag_col=None, end=end)
    g = ffill_bfill(grid, ["oil_price"])
    return g.select(
        "date", "oil_price",
        lag_col("oil_price", 7, spec).alias("oil_price_lag_7"),
        lag_col("oil_price", 14, spec).alias("oil_price_lag_14"),
        rolling_col("oil_price", 28, 1, "mean", 7, spec).alias("oil_price_rolling_mean_28"),
        pct_change("oil_price", 7, spec).alias("oil_price_change_pct"),
    )


def add_oil_features(fact: DataFrame, oil: DataFrame, end=None) -> DataFrame:
    """Join the daily oil table (spine extended to the last fact day; one row per day).

    Fact days before the first quote take the first quote (backward fill of the price only).
    `end` (the last fact day) can be passed to keep the fact's plan out of the spine bounds.
    """
    end = fact.agg(F.max("date")).scalar() if end is None else end
    od = oil_daily(oil, end=F.greatest(end, oil.agg(F.max("date")).scalar()))
    first_price = od.orderBy("date").select("oil_price").limit(1).scalar()
    f = fact.join(od, "date", "left")
    return f.withColumn("oil_price", F.coalesce(F.col("oil_price"), first_price))


def store_encoding_table(stores: DataFrame) -> DataFrame:
    """Per store: type/city/state/cluster, type label code (two names) and per-store frequencies."""
    codes = label_mapping(stores, "type", "store_type_enc")
    s = stores.join(codes, "type", "left").withColumn("store_type_encoded", F.col("store_type_enc"))
    s = frequency_encode(s, "city", base=stores)
    return frequency_encode(s, "state", base=stores)


def add_store_features(fact: DataFrame, stores: DataFrame, freq_base: str = "rows",
                       count_base: DataFrame | None = None) -> DataFrame:
    """Store dimension + encodings. `freq_base='rows'` counts fact rows per city/state
    (the training table's definition; `count_base` = the frame whose rows are counted,
    default `fact`), `'stores'` counts stores (the forecast's)."""
    s = stores.select("store_nbr", "type", "city", "state", "cluster")
    # store_type_encoded: codes of the store table's types; store_type_enc: codes of the
    # types that occur in the fact (the label encoder of the training table is fitted there)
    s = s.join(label_mapping(s, "type", "store_type_encoded"), "type", "left")
    f = fact.join(s, "store_nbr", "left")
    base = fact if count_base is None else count_base
    fact_types = base.select("store_nbr").distinct().join(s.select("store_nbr", "type"), "store_nbr")
    f = f.join(label_mapping(fact_types, "type", "store_type_enc"), "type", "left")
    if freq_base == "stores":
        for c in ("city", "state"):
            f = frequency_encode(f, c, base=stores)
    else:
        # shares of fact rows: counts per store (one aggregate) rolled up to city/state, joined back
        per_store = base.groupBy("store_nbr").agg(F.count(F.lit(1)).alias("_rows"))
        ps = per_store.join(s.select("store_nbr", "city", "state"), "store_nbr")
        ps = ps.withColumn("_total", F.sum("_rows").over(Window.partitionBy()))  # one row per store
        for c in ("city", "state"):
            m = ps.groupBy(c).agg((F.sum("_rows") / F.first("_total")).alias(f"{c}_freq"))
            f = f.join(m, c, "left").withColumn(f"{c}_freq", F.coalesce(F.col(f"{c}_freq"), F.lit(0.0)))
    return f
