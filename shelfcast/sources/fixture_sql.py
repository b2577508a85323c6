"""The fixture views of `fixtures.py` as DuckDB CTEs, for the oracle SQL of each query.

`with_views(body)` prepends only the CTEs the body (transitively) references.
"""

from __future__ import annotations

import re

from shelfcast.sources.fixtures import HOLIDAY_ROWS


def _holiday_values() -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, int):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"

    rows = []
    for seq, d, typ, loc, name, desc, tr in HOLIDAY_ROWS:
        rows.append(f"({seq}, DATE '{d}', {lit(typ)}, {lit(loc)}, {lit(name)}, {lit(desc)}, {lit(tr)})")
    return ",\n    ".join(rows)


CTES: dict[str, str] = {
    "sales_raw": """
  SELECT s.s_nationkey AS store_nbr, p.p_type AS family, CAST(l.l_shipdate AS DATE) AS date,
         CAST(SUM(CAST(l.l_extendedprice * (1 - l.l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS sales,
         CAST(COUNT_IF(l.l_discount >= 0.08) AS DOUBLE) AS onpromotion
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY 1, 2, 3""",
    "sales_panel": """
  SELECT CAST(g.d AS DATE) AS date, k.store_nbr, k.family,
         COALESCE(r.sales, 0.0) AS sales, COALESCE(r.onpromotion, 0.0) AS onpromotion,
         CASE WHEN r.store_nbr IS NULL THEN 1 ELSE 0 END AS is_imputed
  FROM (SELECT DISTINCT store_nbr, family FROM sales_raw) k
  CROSS JOIN (SELECT MIN(date) AS d0, MAX(date) AS d1 FROM sales_raw) b
  CROSS JOIN LATERAL unnest(generate_series(b.d0, b.d1, INTERVAL 1 DAY)) AS g(d)
  LEFT JOIN sales_raw r ON r.store_nbr = k.store_nbr AND r.family = k.family AND r.date = CAST(g.d AS DATE)""",
    "sales_gappy": """
  SELECT * FROM sales_panel WHERE NOT (month(date) = 12 AND day(date) = 25)""",
    "stores": """
  SELECT n.n_nationkey AS store_nbr, 'CITY_' || CAST(n.n_nationkey % 9 AS VARCHAR) AS city, r.r_name AS state,
         substr('ABCDEEEEE', CAST(n.n_nationkey // 3 AS INTEGER) + 1, 1) AS type,
         CAST(n.n_nationkey % 7 + 1 AS INTEGER) AS cluster
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "oil": """
  SELECT CAST(o_orderdate AS DATE) AS date,
         CAST(ROUND(AVG(CAST(o_totalprice AS DECIMAL(18,4))) / 4500, 2) AS DOUBLE) AS dcoilwtico
  FROM orders WHERE isodow(CAST(o_orderdate AS DATE)) <= 5
  GROUP BY 1""",
    "transactions": """
  SELECT CAST(o.o_orderdate AS DATE) AS date, c.c_nationkey AS store_nbr, COUNT(*) AS transactions
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2""",
    "holidays_events": """
  SELECT CAST(event_seq AS INTEGER) AS event_seq, date, type, locale, locale_name, description,
         CAST(transferred AS BOOLEAN) AS transferred
  FROM (VALUES
    """ + _holiday_values() + """
  ) AS h(event_seq, date, type, locale, locale_name, description, transferred)""",
}


def _refs(sql: str, names) -> set[str]:
    return {n for n in names if re.search(rf"\b{n}\b", sql)}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix `body` with the CTEs it needs. `extra` adds query-local CTEs (may use views)."""
    ctes = dict(CTES)
    if extra:
        ctes.update(extra)
    need: list[str] = []

    def visit(name: str, seen: set[str]):
        if name in need or name in seen:
            return
        seen.add(name)
        for dep in sorted(_refs(ctes[name], [n for n in ctes if n != name])):
            visit(dep, seen)
        need.append(name)

    for n in sorted(_refs(body, ctes)):
        visit(n, set())
    # extra CTEs keep their given order after the fixture views they use
    order = [n for n in need if n in CTES and n not in (extra or {})]
    order += [n for n in (extra or {}) if n in need]
    if not order:
        return body
    head = ",\n".join(f"{n} AS ({ctes[n]}\n)" for n in order)
    b = body.lstrip()
    if b[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + head + ",\n" + b[15:]
    if b[:5].upper() == "WITH ":
        return "WITH " + head + ",\n" + b[5:]
    return "WITH " + head + "\n" + body
