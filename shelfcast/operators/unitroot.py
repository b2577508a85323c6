"""Unit-root tests per series in built-in functions: ADF from moment sums, KPSS from lagged products (TS-08..TS-11).

ADF: the products of the change and of the level with every lagged change are summed per series
in one mergeable aggregate. With the first and last values (as many as the longest lag, twice)
these sums give all moments of the regressors (constant, level, lagged changes) and the change,
over the rows of any model. One Cholesky decomposition of the moments gives the residual sum
of squares of every number of lags, and so the AIC's choice; a second one, over the chosen
model's rows and with the level last, gives its t value.

KPSS: partial sums and lagged products of the centred values, with the bandwidth that the
data choose.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import normal_sf
from shelfcast.session import materialize

# MacKinnon (1994) response surface of the ADF test with a constant, one variable:
# bounds, switch point, polynomials for small and large p.
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
# KPSS (1992) critical values of the level test and their significance levels.
KPSS_CRITICAL = (0.347, 0.463, 0.574, 0.739)
KPSS_LEVELS = (0.10, 0.05, 0.025, 0.01)
#: A pivot below this share of its own sum of squares counts as zero: the regressors explain each other, or all.
SINGULAR = 1e-11


def adf_pvalue(stat: Column) -> Column:
    poly = lambda c: sum((F.lit(a) * F.pow(stat, F.lit(i)) for i, a in enumerate(c)), F.lit(0.0))
    inner = normal_sf(-F.when(stat <= TAU_STAR, poly(SMALL_P)).otherwise(poly(LARGE_P)))
    return F.when(stat > TAU_MAX, 1.0).when(stat < TAU_MIN, 0.0).otherwise(inner)


def kpss_pvalue(stat: Column) -> Column:
    """Linear between the published values, and at most and at least those at the ends."""
    out = F.when(stat <= KPSS_CRITICAL[0], KPSS_LEVELS[0])
    for (a, b), (p, q) in zip(zip(KPSS_CRITICAL, KPSS_CRITICAL[1:], strict=False), zip(KPSS_LEVELS, KPSS_LEVELS[1:], strict=False), strict=True):
        out = out.when(stat <= b, p + (stat - a) / (b - a) * (q - p))
    return out.when(stat.isNotNull(), KPSS_LEVELS[-1])


def _added(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)


# The decompositions are put together as SQL text: lambdas in lambdas, parsed in one go.


def _let(value: str, name: str, then: str) -> str:
    """`then` with `name` for the value, which is computed once however often it is named."""
    return f"get(transform(array({value}), {name} -> {then}), 0)"


def _over(low: str, high: str, at: str, value: str) -> str:
    """Sum of `value` over the integers `at` from low to high, none if high < low."""
    return f"aggregate(if(({high}) >= ({low}), sequence({low}, {high}), cast(array() as array<int>)), 0D, (sum_{at}, {at}) -> sum_{at} + ({value}))"


def _last_row(size: str, entry: str) -> str:
    """Last row of the lower triangle of the matrix with `entry` (of i and j, from 1, j <= i); null from a pivot of zero on."""
    known = "aggregate(zip_with(slice(cells, 1, j - 1), slice(above, 1, j - 1), (u, v) -> u * v), 0D, (u, v) -> u + v)"
    pivot = f"if(rest > {SINGULAR:.0e} * ({entry.replace('{j}', 'i').replace('{i}', 'i')}), sqrt(rest), null)"
    cell = _let(f"({entry.replace('{j}', 'j').replace('{i}', 'i')}) - {known}", "rest", f"if(j = i, {pivot}, try_divide(rest, get(above, j - 1)))")
    row = f"aggregate(sequence(1, i), cast(array() as array<double>), (cells, j) -> concat(cells, array({_let('if(j < i, get(done, j - 1), cells)', 'above', cell)})))"
    return f"element_at(aggregate(sequence(1, {size}), cast(array() as array<array<double>>), (done, i) -> concat(done, array({row}))), -1)"


def _moment(a: str, b: str, p: str) -> str:
    """Sum over the changes from p + 1 on of variables a <= b: -2 the constant, -1 the level, k the change k before (0: the change itself).

    The changes are numbered 1 to `_end`, the values 0 to `_end`; `_head` has the first values,
    `_tail` the last ones.
    """
    level, early = (lambda t: f"get(_head, {t})"), (lambda t: f"(get(_head, {t}) - get(_head, {t} - 1))")
    late = lambda back: f"(element_at(_tail, -1 - ({back})) - element_at(_tail, -2 - ({back})))"
    first = lambda value: _over("1", p, "t", value)
    of_changes = f"get(_dd, {b} - {a}) - {_over('0', f'{a} - 1', 't', f'{late("t")} * {late(f"t + {b} - {a}")}')} - {_over(f'{b} - {a} + 1', f'{p} - {a}', 't', f'{early("t")} * {early(f"t - {b} + {a}")}')}"
    return (
        f"case when {a} = -2 then case {b} when -2 then cast(_end - {p} as double) when -1 then _l1 - {first(level('t - 1'))} else element_at(_tail, -1 - {b}) - {level(f'{p} - {b}')} end "
        f"when {a} = -1 then case {b} when -1 then _l2 - {first(f'{level("t - 1")} * {level("t - 1")}')} else get(_ld, {b}) - {_over(f'{b} + 1', p, 't', f'{level("t - 1")} * {early(f"t - {b}")}')} end "
        f"else {of_changes} end"
    )


def _decomposed(order: str, p: str) -> str:
    """Last row for the moments of p + 3 variables; `order`: from the place {at} to the variable."""
    of = lambda at: f"({order.replace('{at}', at)})"
    return _last_row(f"{p} + 3", _let(f"struct(least({of('{i}')}, {of('{j}')}) as a, greatest({of('{i}')}, {of('{j}')}) as b)", "pair", _moment("pair.a", "pair.b", p)))


def adf(df: DataFrame, value: str, keys: list[str], date: str = "date", longest: int | None = None) -> DataFrame:
    """keys, n_obs, adf_stat, adf_lag, adf_pvalue per series: constant, number of lags by the AIC on a common sample.

    At most ceil(12 * (n / 100) ** 0.25) lags (or `longest`, if that is less) and n / 2 - 2. Null values of
    the series are left out. A series of fewer than 10 values, one without variance, or one whose lags
    explain each other or every change has a null statistic. Starts jobs.
    """
    w = Window.partitionBy(*keys).orderBy(date)
    whole = Window.partitionBy(*keys)
    x = df.where(F.col(value).isNotNull()).select(*keys, date, F.col(value).cast("double").alias("_x"))
    lags = F.least(F.ceil(12 * F.pow(F.col("_n") / 100.0, F.lit(0.25))), F.floor(F.col("_n") / 2) - 2, F.lit(longest or 1 << 20)).cast("int")
    most = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max(lags)).first()[0]
    most = max(most or 0, 0)
    d = x.select(*keys, date, (F.col("_x") - F.avg("_x").over(whole)).alias("_c"), F.count(F.lit(1)).over(whole).alias("_n"), (F.row_number().over(w) - 1).alias("_t"))
    d = d.withColumn("_d", F.col("_c") - F.lag("_c").over(w)).withColumn("_l", F.lag("_c").over(w))
    d = d.select("*", *(F.lag("_d", k).over(w).alias(f"_d{k}") for k in range(1, most + 1)))
    change = lambda k: F.col(f"_d{k}" if k else "_d")
    added = lambda v: F.coalesce(F.sum(v), F.lit(0.0))
    edge = lambda here: F.transform(F.sort_array(F.collect_list(F.when(here, F.struct("_t", "_c")))), lambda v: v["_c"])
    g = d.groupBy(*keys).agg(
        F.first("_n").cast("int").alias("_n"), F.max(F.abs("_c")).alias("_spread"), added("_l").alias("_l1"), added(F.col("_l") * F.col("_l")).alias("_l2"),
        F.array(*(added(F.col("_d") * change(k)) for k in range(most + 1))).alias("_dd"), F.array(*(added(F.col("_l") * change(k)) for k in range(most + 1))).alias("_ld"),
        edge(F.col("_t") <= most).alias("_head"), edge(F.col("_t") >= F.col("_n") - 2 - 2 * most).alias("_tail"),
    ).withColumn("_p", lags)
    # a few KB per series; few rows, much work in each: dealt out by a number, which isn't coalesced for their size
    g = materialize(g, "moments")
    g = g.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *keys) if keys else g
    g = g.withColumn("_end", F.col("_n") - 1)
    # constant, level, `_p` lags, the change: what each number of lags leaves unexplained
    yy = _moment("0", "0", "_p")
    ssr = "yy - aggregate(slice(y, 1, k + 2), 0D, (u, v) -> u + v * v)"
    aic = f"if(ssr > {SINGULAR:.0e} * yy and _end - _p > k + 2, (_end - _p) * ({math.log(2 * math.pi) + 1!r}D + ln(ssr / (_end - _p))) + 2 * (k + 2), null)"
    scores = f"transform(sequence(0, _p), k -> struct({_let(ssr, 'ssr', aic)} as aic, k as k))"
    chosen = f"if(element_at(y, -1) is null, null, {_let(yy, 'yy', _let(scores, 'scores', 'if(forall(scores, s -> s.aic is not null), array_min(scores).k, null)'))})"
    row = f"if(_n >= 10 and _spread > 0 and _p >= 0, {_decomposed('case when {at} = _p + 3 then 0 when {at} <= 2 then {at} - 3 else {at} - 2 end', '_p')}, null)"
    g = g.select(*keys, "_n", "_end", "_l1", "_l2", "_dd", "_ld", "_head", "_tail", F.expr(_let(row, "y", chosen)).alias("_best"))
    g = materialize(g, "lags")
    # constant, lagged changes, level, the change, over all rows that this model has
    last = _decomposed("case {at} when 1 then -2 when _best + 2 then -1 when _best + 3 then 0 else {at} - 1 end", "_best")
    stat = _let(f"if(_best is null, null, {last})", "f", "try_divide(get(f, _best + 1), element_at(f, -1) / sqrt(if(_end > 2 * _best + 2, _end - 2 * _best - 2, null)))")
    out = g.select(*keys, F.col("_n").alias("n_obs"), F.expr(stat).alias("adf_stat"), "_best")
    out = out.select(*keys, "n_obs", "adf_stat", F.when(F.col("adf_stat").isNotNull(), F.col("_best")).cast("int").alias("adf_lag"))
    return out.withColumn("adf_pvalue", adf_pvalue(F.col("adf_stat")))


def kpss(df: DataFrame, value: str, keys: list[str], date: str = "date") -> DataFrame:
    """keys, n_obs, kpss_stat, kpss_lags, kpss_pvalue per series: around a level, Bartlett weights, automatic bandwidth.

    The bandwidth is that of Hobijn, Franses and Ooms (1998). Null values of the series are left
    out; one of fewer than 3 values or without variance has a null statistic.
    """
    x = df.where(F.col(value).isNotNull()).select(*keys, F.struct(F.col(date).alias("t"), F.col(value).cast("double").alias("x")).alias("_v"))
    s = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.avg("_v.x").alias("_mean"), F.sort_array(F.collect_list("_v")).alias("_all"))
    n = F.col("_n").cast("double")
    s = s.withColumn("_e", F.transform("_all", lambda v: v["x"] - F.col("_mean")))
    product = lambda k: _added(F.zip_with(F.slice("_e", k + 1, F.col("_n").cast("int") - k), F.slice("_e", F.lit(1), F.col("_n").cast("int") - k), lambda a, b: a * b))
    s = s.withColumn("_c0", product(F.lit(0)))
    pilot = F.transform(F.sequence(F.lit(1), F.floor(F.pow(n, F.lit(2.0 / 9.0))).cast("int")), lambda k: F.struct(k.alias("k"), product(k).alias("c")))
    s = s.withColumn("_pilot", F.when((F.col("_n") >= 3) & (F.col("_c0") > 0), pilot))
    level = F.col("_c0") + 2 * _added(F.transform("_pilot", lambda p: p["c"]))
    slope = 2 * _added(F.transform("_pilot", lambda p: p["k"] * p["c"]))
    width = 1.1447 * F.pow(F.pow(F.try_divide(slope, level), F.lit(2.0)) * n, F.lit(1.0 / 3.0))
    s = s.withColumn("kpss_lags", F.least(F.floor(width), F.col("_n") - 1).cast("int"))
    weighted = F.transform(F.when(F.col("kpss_lags") > 0, F.sequence(F.lit(1), F.col("kpss_lags"))).otherwise(F.slice(F.array(F.lit(0)), 1, 0)), lambda k: product(k) * (1 - k / (F.col("kpss_lags") + 1.0)))
    spread = (F.col("_c0") + 2 * _added(weighted)) / n
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
    squares = F.aggregate("_e", start, lambda a, e: F.struct((a["s"] + e).alias("s"), (a["q"] + (a["s"] + e) * (a["s"] + e)).alias("q")))["q"]
    s = s.select(*keys, F.col("_n").cast("int").alias("n_obs"), F.when(F.col("kpss_lags").isNotNull(), F.try_divide(squares / (n * n), spread)).alias("kpss_stat"), "kpss_lags")
    return s.withColumn("kpss_pvalue", kpss_pvalue(F.col("kpss_stat")))


def unit_root_tests(df: DataFrame, value: str, keys: list[str], date: str = "date", diffs=(0,), tests=("adf", "kpss"), longest: int | None = None) -> DataFrame:
    """Both tests per series and order of differencing `d`, with rejections at 5 % and a verdict (TS-10).

    A null statistic rejects nothing; columns of a test that isn't asked for are null.
    """
    out = None
    for d in diffs:
        z = df.where(F.col(value).isNotNull()).select(*keys, date, F.col(value).cast("double").alias("_z"))
        for _ in range(d):
            z = z.withColumn("_z", F.col("_z") - F.lag("_z").over(Window.partitionBy(*keys).orderBy(date))).where("_z is not null")
        empty = {"adf_stat": "double", "adf_lag": "int", "adf_pvalue": "double", "kpss_stat": "double", "kpss_lags": "int", "kpss_pvalue": "double"}
        found = [adf(z, "_z", keys, date, longest)] if "adf" in tests else []
        found += [kpss(z, "_z", keys, date)] if "kpss" in tests else []
        r = found[0] if len(found) == 1 else found[0].join(found[1].drop("n_obs"), keys) if keys else found[0].crossJoin(found[1].drop("n_obs"))  # without keys: one row each
        r = r.withColumns({c: F.lit(None).cast(t) for c, t in empty.items() if c not in r.columns})
        reject = {k: F.coalesce(F.col(f"{k}_pvalue") < 0.05, F.lit(False)) if k in tests else F.lit(None).cast("boolean") for k in ("adf", "kpss")}
        r = r.withColumns({f"{k}_reject": c for k, c in reject.items()})
        r = r.select(*keys, F.lit(d).alias("d"), "n_obs", *("adf_stat adf_lag adf_pvalue adf_reject kpss_stat kpss_lags kpss_pvalue kpss_reject".split()), verdict(F.col("adf_reject"), F.col("kpss_reject")).alias("verdict"))
        out = r if out is None else out.unionByName(r)
    return out


def verdict(adf_reject: Column, kpss_reject: Column) -> Column:
    known = adf_reject.isNotNull() & kpss_reject.isNotNull()
    name = F.when(adf_reject, F.when(kpss_reject, "trend-stationary").otherwise("stationary")).otherwise(F.when(kpss_reject, "non-stationary").otherwise("difference-stationary"))
    return F.when(known, name)
