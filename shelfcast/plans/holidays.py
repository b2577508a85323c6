"""Holiday features (F-08..F-10, F-12) and holiday windows (J-05, J-08, J-10, W-15).

The holiday calendar is a small dimension. Matching is done at its own grain -
(date) for national, (date, state) for regional, (date, city) for local rows -
and the fact joins the three small match tables; the fact is never
expanded by holidays and holidays are never expanded by stores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.calendar import in_periods
from shelfcast.functions.numeric import exact_sum
from shelfcast.operators.joins import nearest_event_distance
from shelfcast.spec import SHOCK_PERIODS

# Holiday type -> code (unlisted types map to 0).
TYPE_CODES = {"Holiday": 1, "Event": 2, "Additional": 3, "Transfer": 4, "Bridge": 5, "Work Day": 0}
# Dedup priority per type for the holiday analysis table (others 4).
TYPE_PRIORITY = {"Bridge": 1, "Transfer": 2, "Holiday": 3}
# Names of the features and of the scopes with their flags.
HOLIDAY_FEATURES = [
    "is_national_holiday", "is_regional_holiday", "is_local_holiday",
    "is_transferred_holiday", "holiday_type", "is_carnaval_feature",
    "days_to_next_holiday", "days_after_last_holiday", "is_earthquake_period",
]
SCOPES = (("National", "is_national_holiday", None), ("Regional", "is_regional_holiday", "state"),
          ("Local", "is_local_holiday", "city"))


def map_code(col: str | Column, mapping: dict, default=0) -> Column:
    """Static value mapping with a default for unlisted values (P-13)."""
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[c], F.lit(default))


def text_flag(col: str, needle: str) -> Column:
    """Case-insensitive contains; NULL text is false (P-12)."""
    return F.coalesce(F.lower(F.col(col)).contains(needle.lower()), F.lit(False)).cast("int")


def valid_holidays(h: DataFrame) -> DataFrame:
    """Rows not moved away (`transferred = false`; NULL drops), with type code and text flags."""
    return h.filter(F.col("transferred") == F.lit(False)).select(
        "*",
        map_code("type", TYPE_CODES).cast("int").alias("holiday_type_encoded"),
        text_flag("description", "carnaval").alias("is_carnaval"),
        (F.col("type") == "Transfer").cast("int").alias("is_makeup"),
    )


def _scope_matches(vh: DataFrame, locale: str, flag: str, geo: str | None) -> DataFrame:
    """Per (date[, geo]): the scope flag and the last row in file order (max event_seq)."""
    keys = ["date"] + ([geo] if geo else [])
    rows = vh.filter(F.col("locale") == locale)
    if geo:
        rows = rows.withColumn(geo, F.col("locale_name"))
    last = F.max(F.struct("event_seq", "is_makeup", "holiday_type_encoded", "is_carnaval"))
    return rows.groupBy(*keys).agg(F.lit(1).alias(flag), last.alias(f"_last_{flag}"))


def add_holiday_flags(fact: DataFrame, stores: DataFrame, holidays: DataFrame) -> DataFrame:
    """Scope flags OR-ed; type / make-up / carnaval taken from the last matching row in file order.

    `fact` needs date and store_nbr; store city/state come from the store dimension.
    """
    vh = valid_holidays(holidays)
    f = fact.join(stores.select("store_nbr", F.col("city").alias("_city"),
                                            F.col("state").alias("_state")), "store_nbr", "left")
    lasts = []
    for locale, flag, geo in SCOPES:
        m = _scope_matches(vh, locale, flag, geo)
        if geo:
            m = m.withColumnRenamed(geo, f"_{geo}")
            f = f.join(m, ["date", f"_{geo}"], "left")
        else:
            f = f.join(m, ["date"], "left")
        lasts.append(F.col(f"_last_{flag}"))
    win = F.greatest(*lasts)
    out = f.select(
        *[F.col(c) for c in fact.columns],
        *[F.coalesce(F.col(flag), F.lit(0)).alias(flag) for _, flag, _ in SCOPES],
        F.coalesce(win["is_makeup"], F.lit(0)).alias("is_transferred_holiday"),
        F.coalesce(win["holiday_type_encoded"], F.lit(0)).alias("holiday_type"),
        F.coalesce(win["is_carnaval"], F.lit(0)).alias("is_carnaval_feature"),
    )
    return out


def holiday_halo(dates: DataFrame, holidays: DataFrame) -> DataFrame:
    """Per distinct date: days to the next / since the last valid holiday (strict; -1 if none)."""
    return nearest_event_distance(dates, valid_holidays(holidays).select("date"))


def add_holiday_features(fact: DataFrame, stores: DataFrame, holidays: DataFrame,
                         shock_periods=SHOCK_PERIODS, dates: DataFrame | None = None) -> DataFrame:
    """All nine holiday features; the halo is computed on distinct dates and joined back.

    `dates`: where the fact's days can be read more cheaply than from the fact's plan.
    """
    f = add_holiday_flags(fact, stores, holidays)
    halo = holiday_halo(fact.select("date") if dates is None else dates, holidays)
    f = f.join(halo, "date", "left")
    return f.withColumn("is_earthquake_period", in_periods("date", shock_periods))


# ---------------------------------------------------------------- analysis table (F-12)

def dedup_priority(h: DataFrame) -> DataFrame:
    """One row per date: lowest priority code first, file order breaks ties (W-15)."""
    pr = map_code("type", TYPE_PRIORITY, 4)
    w = Window.partitionBy("date").orderBy(pr, F.col("event_seq"))
    return h.withColumn("priority", pr).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def holiday_periods(event_dates: DataFrame, days: int = 2) -> DataFrame:
    """date -> period_type for days within +-`days` of an event; During > Before > After (J-10)."""
    off = event_dates.select(F.col("date").alias("_e"), F.explode(F.sequence(F.lit(-days), F.lit(days))).alias("_o"))
    # the tagged day is before the event when the offset is negative
    rank = F.when(F.col("_o") == 0, 1).when(F.col("_o") < 0, 2).otherwise(3)
    tagged = off.select(F.date_add("_e", "_o").alias("date"), rank.alias("_r"))
    best = tagged.groupBy("date").agg(F.min("_r").alias("_r"))
    label = F.when(F.col("_r") == 1, "During Holiday").when(F.col("_r") == 2, "Before Holiday").otherwise("After Holiday")
    return best.select("date", label.alias("period_type"))


def holiday_analysis(daily: DataFrame, oil_daily: DataFrame, holidays: DataFrame) -> DataFrame:
    """Daily totals + oil + top-priority holiday row + flags and period type (F-12)."""
    top = dedup_priority(holidays).select("date", "type", "locale", "description", "transferred")
    d = daily.join(oil_daily, "date", "left").join(top, "date", "left")
    d = d.withColumn("is_holiday_event", F.col("type").isNotNull() & (F.coalesce(F.col("transferred"), F.lit(True)) == F.lit(False)))
    d = d.withColumn("holiday_category", F.coalesce("type", F.lit("Normal"))).withColumn(
        "locale_category", F.coalesce("locale", F.lit("None")))
    events = d.filter("is_holiday_event").select("date")
    per = holiday_periods(events)
    return d.join(per, "date", "left").withColumn(
        "period_type", F.coalesce("period_type", F.lit("Normal")))


def exposure(fact: DataFrame, stores: DataFrame, holidays: DataFrame, value: str = "sales") -> DataFrame:
    """One row per (store, day with rows in `fact`, entry of the calendar that holds there): the entry, `value` summed, rows of `fact`.

    All entries count, also transferred ones. A national entry holds in every store, a regional
    one in the stores of its state, a local one in those of its city. The fact is summed to a
    store's days before it meets the calendar, so it is shuffled once and never multiplied.
    """
    days = fact.groupBy("store_nbr", "date").agg(exact_sum(value).alias(value), F.count(F.lit(1)).alias("n_rows"))
    entries = holidays.select("date", "event_seq", "type", "locale", "locale_name", "description", "transferred")
    found = days.join(entries, "date").join(stores.select("store_nbr", "city", "state"), "store_nbr", "left")
    here = F.when(F.col("locale") == "Regional", F.col("locale_name") == F.col("state")).when(F.col("locale") == "Local", F.col("locale_name") == F.col("city")).otherwise(F.col("locale") == "National")
    return found.where(here).select("store_nbr", "date", "event_seq", "type", "locale", "description", "transferred", value, "n_rows")
