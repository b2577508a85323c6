"""Calendar entries where they hold: scopes, unknown places, transferred and repeated entries."""

import datetime as dt

from shelfcast.plans.holidays import exposure

D1, D2, D3 = (dt.date(2020, 1, k) for k in (1, 2, 3))


def test_entries_hold_in_their_scope_only(spark):
    fact = spark.createDataFrame([(1, "a", D1, 2.0), (1, "b", D1, 3.0), (2, "a", D1, 7.0), (9, "a", D1, 1.0), (2, "a", D2, None), (1, "a", D3, 5.0)], "store_nbr int, family string, date date, sales double")
    stores = spark.createDataFrame([(1, "C1", "S1"), (2, "C2", "S1"), (3, None, None)], "store_nbr int, city string, state string")
    entries = [(1, D1, "Holiday", "National", "X", "n", False), (2, D1, "Event", "Regional", "S1", None, True), (3, D1, "Bridge", "Local", "C2", "l", None),
               (4, D2, "Event", "Regional", None, "unknown", False), (5, D2, "Event", None, "S1", "no scope", False), (6, D2, "Holiday", "National", "X", "n2", False)]
    calendar = spark.createDataFrame(entries, "event_seq int, date date, type string, locale string, locale_name string, description string, transferred boolean")
    rows = {(r["store_nbr"], r["event_seq"]): (r["sales"], r["n_rows"]) for r in exposure(fact, stores, calendar).collect()}
    assert rows == {(1, 1): (5.0, 2), (2, 1): (7.0, 1), (9, 1): (1.0, 1), (1, 2): (5.0, 2), (2, 2): (7.0, 1), (2, 3): (7.0, 1), (2, 6): (None, 1)}
    assert exposure(fact, stores, calendar.unionByName(calendar)).count() == 2 * len(rows)
    assert exposure(fact.limit(0), stores, calendar).count() == exposure(fact, stores, calendar.limit(0)).count() == 0
