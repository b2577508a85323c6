"""Reusable DuckDB SQL fragments for oracle queries."""

from shelfcast.spec import DEFAULT_SPLIT


def split_case(date: str = "date") -> str:
    parts = [f"WHEN {date} BETWEEN DATE '{a}' AND DATE '{b}' THEN '{n}'" for n, a, b in DEFAULT_SPLIT.ranges()]
    return "CASE " + " ".join(parts) + " END"


def exact_mean_sql(value: str, over: str, scale: int, digits: int) -> str:
    """Decimal mean (half-up at scale + 4, as Spark's decimal average), then half-up to `digits`,
    in integer arithmetic; for non-negative values."""
    win = f" OVER ({over})" if over else ""
    s_units = f"CAST(SUM(CAST({value} AS DECIMAL(18,{scale}))){win} * {10 ** scale} AS HUGEINT)"
    n = f"count({value}){win}"
    q = f"(({s_units}) * 20000 + {n}) // (2 * {n})"
    drop = scale + 4 - digits
    if drop <= 0:
        return f"(CAST({q} AS DOUBLE) / {10.0 ** (scale + 4)})"
    return f"(CAST(({q} + {5 * 10 ** (drop - 1)}) // {10 ** drop} AS DOUBLE) / {10.0 ** digits})"


def rolling_sql(value: str, window: int, offset: int, stat: str, min_periods: int,
                part: str = "store_nbr, family", order: str = "date", exact: tuple[int, int] | None = None) -> str:
    """`exact=(scale, digits)`: mean computed as a rounded decimal mean (see `exact_mean_sql`)."""
    fn = {"mean": "avg", "std": "stddev_samp", "sum": "sum", "min": "min", "max": "max"}[stat]
    fr = (f"PARTITION BY {part} ORDER BY {order} " if part else f"ORDER BY {order} ") + \
        f"ROWS BETWEEN {offset + window - 1} PRECEDING AND {offset} PRECEDING"
    if offset < 0:
        fr = fr.replace(f"AND {offset} PRECEDING", f"AND {-offset} FOLLOWING")
    if offset == 0:
        fr = fr.replace("AND 0 PRECEDING", "AND CURRENT ROW")
    if stat == "mean" and exact is not None:
        return f"CASE WHEN count({value}) OVER ({fr}) >= {min_periods} THEN {exact_mean_sql(value, fr, *exact)} END"
    return f"CASE WHEN count({value}) OVER ({fr}) >= {min_periods} THEN {fn}({value}) OVER ({fr}) END"


def metrics_sql(actual: str = "actual", pred: str = "predicted", digits: int = 6) -> str:
    ok = f"({pred} IS NOT NULL AND {actual} IS NOT NULL)"
    y = f"CASE WHEN {ok} THEN greatest({actual}, 0.0) END"
    p = f"CASE WHEN {ok} THEN greatest({pred}, 0.0) END"
    d2 = f"(ln(1 + {p}) - ln(1 + {y}))"
    return (f"round(sqrt(avg({d2} * {d2})), {digits}) AS rmsle, "
            f"round(sqrt(avg(({p} - {y}) * ({p} - {y}))), {digits}) AS rmse, "
            f"round(avg(abs({p} - {y})), {digits}) AS mae, "
            f"round(sqrt(avg({d2} * {d2})), {digits}) AS rmse_log, "
            f"count({p}) AS n")
