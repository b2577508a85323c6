"""Retail-panel views over the driver's TPC-H-style tables.

The driver tables hold no retail panel, so every registered query starts from
these views (definitions in FIXTURES.md section 3). Each view is lazy and
column-pruned; no view collects to the driver.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.numeric import exact_sum
from shelfcast.operators.panel import complete_panel
from shelfcast.sources.segments import stored
from shelfcast.sources.tables import table
from shelfcast.spec import DEFAULT_PANEL, PanelSpec


def _day(c: str) -> Column:
    # Timestamps in the driver tables carry no zone; cast to a calendar day.
    return F.to_date(F.col(c))


SALES_TABLES = ("lineitem", "part", "supplier")


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`sales_cells`, stored: summed once per session, whatever number of reports reads it."""
    return stored(spark, sf_dir, "sales-cells", SALES_TABLES, lambda: sales_cells(spark, sf_dir))


def sales_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(store_nbr, family, date) -> sales, onpromotion from lineitem x part x supplier.

    Sales are summed as decimal(18,4) so the total does not depend on the order of
    addition; part and supplier are left to the planner.
    """
    li = table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_shipdate"])
    part = table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    sup = table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    j = li.join(part, li.l_partkey == part.p_partkey).join(sup, li.l_suppkey == sup.s_suppkey)
    amount = (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).cast("decimal(18,4)")
    return j.groupBy(
        F.col("s_nationkey").alias("store_nbr"),
        F.col("p_type").alias("family"),
        _day("l_shipdate").alias("date"),
    ).agg(
        F.sum(amount).cast("double").alias("sales"),
        F.count_if(F.col("l_discount") >= 0.08).cast("double").alias("onpromotion"),
    )


def sales_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full (date x series) grid over the global date range, zero filled, with `is_imputed`."""
    return complete_panel(
        sales_raw(spark, sf_dir),
        DEFAULT_PANEL,
        fill={"sales": 0.0, "onpromotion": 0.0},
        flag_col="is_imputed",
    )


def sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, total): the panel's sales by day. Days without sales come from a date spine, not from a series x day grid."""
    def build() -> DataFrame:
        totals = sales_raw(spark, sf_dir).groupBy("date").agg(exact_sum("sales").alias("total"))
        return complete_panel(totals, PanelSpec(keys=(), target="total"), fill={"total": 0.0}, flag_col=None)

    return stored(spark, sf_dir, "sales-by-day", SALES_TABLES, build)


def sales_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`sales_panel` without 25 December: row lags and calendar lags differ on it."""
    p = sales_panel(spark, sf_dir)
    return p.filter(~((F.month("date") == 12) & (F.dayofmonth("date") == 25)))


def future(spark: SparkSession, sf_dir: str, start, days: int) -> DataFrame:
    """The rows to forecast: id, date, series, and the promotions planned (those of four weeks before)."""
    p = sales_panel(spark, sf_dir).where(F.col("date").between(F.date_sub(F.lit(start), 28), F.date_add(F.date_sub(F.lit(start), 28), days - 1)))
    p = p.select(F.date_add("date", 28).alias("date"), "store_nbr", "family", "onpromotion")
    return p.withColumn("id", F.concat_ws("_", F.col("date").cast("string"), F.col("store_nbr").cast("string"), "family"))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store dimension (one row per nation): store_nbr, city, state, type, cluster."""
    n = table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    r = table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    k = F.col("n_nationkey")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        k.alias("store_nbr"),
        F.concat(F.lit("CITY_"), (k % 9).cast("string")).alias("city"),
        F.col("r_name").alias("state"),
        F.substring(F.lit("ABCDEEEEE"), (F.floor(k / 3) + 1).cast("int"), 1).alias("type"),
        (k % 7 + 1).cast("int").alias("cluster"),
    )


def oil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date-only external series: weekday order value level; weekends are gaps."""
    o = table(spark, sf_dir, "orders", ["o_orderdate", "o_totalprice"])
    d = _day("o_orderdate")
    return (
        o.filter(F.weekday(d) < 5)
        .groupBy(d.alias("date"))
        .agg(F.round(F.avg(F.col("o_totalprice").cast("decimal(18,4)")) / 4500, 2).cast("double").alias("dcoilwtico"))
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse (date, store_nbr) -> transactions panel from orders x customer."""
    o = table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy(_day("o_orderdate").alias("date"), F.col("c_nationkey").alias("store_nbr"))
        .agg(F.count(F.lit(1)).alias("transactions"))
    )


HOLIDAY_SCHEMA = T.StructType(
    [
        T.StructField("event_seq", T.IntegerType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("type", T.StringType(), True),
        T.StructField("locale", T.StringType(), True),
        T.StructField("locale_name", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
        T.StructField("transferred", T.BooleanType(), True),
    ]
)

# The holiday calendar of the fixture (FIXTURES.md section 4), in file order.
HOLIDAY_ROWS = [
    (1, "1996-01-01", "Holiday", "National", "Country", "New year", False),
    (2, "1996-02-19", "Holiday", "National", "Country", "Carnaval", False),
    (3, "1996-02-20", "Holiday", "National", "Country", "second day of carnaval", False),
    (4, "1997-05-24", "Holiday", "National", "Country", "Battle day", True),
    (5, "1997-05-26", "Transfer", "National", "Country", "Battle day moved", False),
    (6, "1997-05-26", "Holiday", "Local", "CITY_3", "Founding of city 3", False),
    (7, "1998-06-25", "Holiday", "Regional", "ASIA", "Province day", False),
    (8, "1998-06-25", "Event", "Local", "CITY_5", None, False),
    (9, "1998-12-26", "Additional", "National", "Country", "After Christmas", False),
    (10, "1999-12-24", "Bridge", "National", "Country", "Bridge before Christmas", False),
    (11, "2000-01-15", "Work Day", "National", "Country", "Recovered work day", False),
    (12, "2000-07-04", "Festival", "National", "Country", "Unlisted type", False),
    (13, "1999-03-01", "Holiday", "National", "Country", "Unknown status", None),
    (14, "1999-08-10", "Holiday", "Zonal", "Zone 1", "Unlisted locale", False),
    (15, "2001-10-09", "Holiday", "National", "Country", "Independence", True),
    (16, "2001-10-12", "Transfer", "National", "Country", "Independence moved", False),
    (17, "2001-11-02", "Holiday", "National", "Country", "Day of the dead", False),
    (18, "2001-11-03", "Holiday", "Local", "CITY_1", "Founding of city 1", False),
    (19, "2001-11-06", "Holiday", "Regional", "EUROPE", "Region day", False),
]


def holidays_events(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """The holiday calendar (a small dimension; `event_seq` is its file order).

    Built as an inline JVM table (generator over literals), so scanning it needs no
    Python worker.
    """
    rows = []
    for seq, d, typ, loc, name, desc, tr in HOLIDAY_ROWS:
        rows.append(F.struct(
            F.lit(seq).cast("int").alias("event_seq"), F.lit(d).cast("date").alias("date"),
            F.lit(typ).cast("string").alias("type"), F.lit(loc).cast("string").alias("locale"),
            F.lit(name).cast("string").alias("locale_name"), F.lit(desc).cast("string").alias("description"),
            F.lit(tr).cast("boolean").alias("transferred")))
    return spark.range(1).select(F.inline(F.array(*rows)))


VIEWS = {
    "sales_raw": sales_raw,
    "sales_panel": sales_panel,
    "sales_gappy": sales_gappy,
    "stores": stores,
    "oil": oil,
    "transactions": transactions,
    "holidays_events": holidays_events,
}
