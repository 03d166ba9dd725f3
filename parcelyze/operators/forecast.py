"""Holt (additive trend, no seasonality) forecasts, one series per key.

The reference fits one global monthly series with a numeric optimizer. Here
every key (global, state, seller, ...) is fitted in parallel as a Spark job:

* the series of a key is its monthly counts (an aggregate: one element per
  month, bounded by the calendar, not by data volume), held as a sorted array;
* for fixed smoothing (alpha, beta) the one-step errors are affine in the
  initial state (l0, b0). One SQL aggregate() pass over the array carries the
  zero-start state, the two unit-start responses and six sums of products, so
  the least-squares (l0, b0) come from a 2x2 normal equation -- no optimizer;
* (alpha, beta) is searched on a grid (beta <= alpha) generated per key with
  explode(sequence()), then refined on a finer grid around the winner; the
  best fit per key is min(struct(sse, alpha, beta, ...)), a plain group-by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STATE = ["l", "b", "lu", "bu", "lv", "bv", "suu", "suv", "svv", "sur", "svr", "srr"]


def series_arrays(series: DataFrame, keys=(), period: str = "year_month",
                  value: str = "order_count") -> DataFrame:
    """Per key: points sorted by period, plus the last period."""
    return (series.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(period).alias("t"),
                                                      F.col(value).cast("double").alias("y"))))
                 .alias("pts"), F.max(period).alias("last_period")))


def fill_gaps(series: DataFrame, keys=(), period: str = "year_month", value: str = "order_count") -> DataFrame:
    """The series with a 0 for every month without a row between a key's first
    and last month. The default series skips such months."""
    keys = list(keys)
    month = F.to_date(F.concat(F.col(period), F.lit("-01")))
    span = series.groupBy(*keys).agg(F.min(month).alias("lo"), F.max(month).alias("hi"))
    every = span.filter("lo IS NOT NULL").select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("_period")).withColumn(
        "_period", F.date_format("_period", "yyyy-MM"))
    j = every.join(series, _same_keys(series, every, keys) & (F.col(period) == F.col("_period")), "left")
    return j.select(*[F.col(f"_k_{k}").alias(k) for k in keys], F.col("_period").alias(period),
                    F.coalesce(F.col(value), F.lit(0)).cast("bigint").alias(value))


def _holt_pass(pts: Column, a: Column, bt: Column) -> Column:
    """One fold over the series for fixed (alpha, beta); the finish step solves
    the 2x2 normal equation, so the result is a struct (l0, b0, sse, level,
    trend) computed once per row."""
    z = F.lit(0.0)
    init = F.struct(*[x.alias(n) for n, x in zip(_STATE, [z, z, F.lit(1.0), z, z, F.lit(1.0),
                                                           z, z, z, z, z, z])])

    def step(s, p):
        y = p["y"]
        r = y - (s["l"] + s["b"])          # error with a zero initial state
        u = s["lu"] + s["bu"]              # prediction response to l0 = 1
        v = s["lv"] + s["bv"]              # prediction response to b0 = 1
        l2 = a * y + (1 - a) * (s["l"] + s["b"])
        lu2 = (1 - a) * (s["lu"] + s["bu"])
        lv2 = (1 - a) * (s["lv"] + s["bv"])
        return F.struct(
            l2.alias("l"), (bt * (l2 - s["l"]) + (1 - bt) * s["b"]).alias("b"),
            lu2.alias("lu"), (bt * (lu2 - s["lu"]) + (1 - bt) * s["bu"]).alias("bu"),
            lv2.alias("lv"), (bt * (lv2 - s["lv"]) + (1 - bt) * s["bv"]).alias("bv"),
            (s["suu"] + u * u).alias("suu"), (s["suv"] + u * v).alias("suv"),
            (s["svv"] + v * v).alias("svv"), (s["sur"] + u * r).alias("sur"),
            (s["svr"] + v * r).alias("svr"), (s["srr"] + r * r).alias("srr"))

    def finish(s):
        det = s["suu"] * s["svv"] - s["suv"] * s["suv"]
        l0 = F.try_divide(s["svv"] * s["sur"] - s["suv"] * s["svr"], det)
        b0 = F.try_divide(s["suu"] * s["svr"] - s["suv"] * s["sur"], det)
        sse = (s["srr"] - 2 * (l0 * s["sur"] + b0 * s["svr"])
               + l0 * l0 * s["suu"] + 2 * l0 * b0 * s["suv"] + b0 * b0 * s["svv"])
        return F.struct(l0.alias("l0"), b0.alias("b0"), sse.alias("sse"),
                        (s["l"] + l0 * s["lu"] + b0 * s["lv"]).alias("level"),
                        (s["b"] + l0 * s["bu"] + b0 * s["bv"]).alias("trend"))

    return F.aggregate(pts, init, step, finish)


def _fit_rows(arrays: DataFrame, keys, alpha: Column, beta: Column) -> DataFrame:
    """Evaluate one (alpha, beta) per row: best (l0, b0), SSE, final level/trend.

    The fold result is expanded with inline() (a generator): later projections
    read its output columns instead of re-inlining the fold per field."""
    fit = _holt_pass(F.col("pts"), F.col("alpha"), F.col("beta"))
    return (arrays.select(*keys, "last_period", "pts", alpha.alias("alpha"), beta.alias("beta"))
            .select(*keys, "last_period", "alpha", "beta", F.inline(F.array(fit))))


def _best(rows: DataFrame, keys) -> DataFrame:
    best = rows.filter(F.col("sse").isNotNull()).groupBy(*keys).agg(F.min(F.struct(
        "sse", "alpha", "beta", "l0", "b0", "level", "trend", "last_period")).alias("m"))
    return best.select(*keys, "m.*")


def _same_keys(left: DataFrame, right: DataFrame, keys) -> Column:
    """Null-safe equality of the key columns; ``right`` has them as _k_<name>."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_k_{k}"])
    return cond


def _with_best(arr: DataFrame, ab: Column) -> DataFrame:
    return arr.withColumn("_ab", ab).withColumn("_a0", F.col("_ab.a")) \
              .withColumn("_b0", F.col("_ab.b")).drop("_ab")


def holt_fit(series: DataFrame, keys=(), period: str = "year_month", value: str = "order_count",
             step: float = 0.01, refine: bool = True) -> DataFrame:
    """One row per key (a NULL key included): alpha, beta, l0, b0, sse, final level
    and trend; all NULL but ``last_period`` for a key whose series is too short to
    fit (fewer than two periods)."""
    keys = list(keys)
    arr = series_arrays(series, keys, period, value)
    n = int(round(1 / step))
    coarse = (arr.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(n))))
              .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_i")))))
    best = _best(_fit_rows(coarse, keys, F.col("_i") / n, F.col("_j") / n), keys)
    if not refine:
        return _every_key(arr, best, keys)
    fine_n = 10 * n
    won = best.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                      F.col("alpha").alias("_a0"), F.col("beta").alias("_b0"))
    around = (arr.join(won, _same_keys(arr, won, keys), "inner") if keys else
              # one struct-valued scalar subquery (reused), not one per field
              _with_best(arr, best.select(F.struct(F.col("alpha").alias("a"),
                                                   F.col("beta").alias("b"))).scalar()))
    fine = (around
            .withColumn("_i", F.explode(F.sequence(F.lit(-10), F.lit(10))))
            .withColumn("_j", F.explode(F.sequence(F.lit(-10), F.lit(10))))
            .withColumn("_ai", F.round(F.col("_a0") * fine_n).cast("int") + F.col("_i"))
            .withColumn("_bi", F.round(F.col("_b0") * fine_n).cast("int") + F.col("_j"))
            .filter((F.col("_ai") >= 1) & (F.col("_ai") <= fine_n)
                    & (F.col("_bi") >= 0) & (F.col("_bi") <= F.col("_ai"))))
    return _every_key(arr, _best(_fit_rows(fine, keys, F.col("_ai") / fine_n, F.col("_bi") / fine_n), keys), keys)


# ------------------------------------------------------- iterative least squares
#: Smallest level smoothing that is searched, as on the grid.
_LEAST_ALPHA = 0.001


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once: the one element of an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _slopes(pts: Column, s) -> Column:
    """One fold at (alpha, share, l0, b0), with beta = alpha * share: the derivatives of
    the one-step predictions by alpha and share are carried along, and what is left of
    their sums of products once the initial state is fitted again (haa, has, hss: the
    2x2 matrix; ga, gs: products with the errors)."""
    a, g = s["alpha"], s["share"]
    z, one = F.lit(0.0), F.lit(1.0)
    sums = ["aa", "as", "ss", "au", "av", "su", "sv", "uu", "uv", "vv", "ae", "se"]
    init = F.struct(s["l0"].alias("l"), s["b0"].alias("b"), z.alias("la"), z.alias("ba"), z.alias("ls"), z.alias("bs"),
                    one.alias("lu"), z.alias("bu"), z.alias("lv"), one.alias("bv"), *[z.alias(n) for n in sums])

    def step(x, p):
        f = x["l"] + x["b"]
        fa, fs, u, v = x["la"] + x["ba"], x["ls"] + x["bs"], x["lu"] + x["bu"], x["lv"] + x["bv"]
        e = p["y"] - f
        k = a * a * g                                        # alpha * beta
        part = {"a": fa, "s": fs, "u": u, "v": v, "e": e}
        return F.struct(
            (f + a * e).alias("l"), (x["b"] + k * e).alias("b"),
            (fa + e - a * fa).alias("la"), (x["ba"] + 2 * a * g * e - k * fa).alias("ba"),
            (fs - a * fs).alias("ls"), (x["bs"] + a * a * e - k * fs).alias("bs"),
            (u - a * u).alias("lu"), (x["bu"] - k * u).alias("bu"),
            (v - a * v).alias("lv"), (x["bv"] - k * v).alias("bv"),
            *[(x[n] + part[n[0]] * part[n[1]]).alias(n) for n in sums])

    def finish(x):
        det = x["uu"] * x["vv"] - x["uv"] * x["uv"]

        def without_state(n, p, q):                          # a product less its part in the span of u and v
            pu, pv, qu, qv = (x[i + j] for i in (p, q) for j in "uv")
            return x[n] - F.try_divide(pu * qu * x["vv"] - (pu * qv + pv * qu) * x["uv"] + pv * qv * x["uu"], det)
        return F.struct(without_state("aa", "a", "a").alias("haa"), without_state("as", "a", "s").alias("has"),
                        without_state("ss", "s", "s").alias("hss"), x["ae"].alias("ga"), x["se"].alias("gs"))
    return F.aggregate(pts, init, step, finish)


def _moved(s, d) -> Column:
    """The damped step inside alpha in [least, 1], share in [0, 1]. A parameter that would
    leave its range stays, and the other one moves alone."""
    damp = 1 + s["damp"]
    stuck_a = ((s["alpha"] >= 1) & (d["ga"] > 0)) | ((s["alpha"] <= _LEAST_ALPHA) & (d["ga"] < 0))
    stuck_s = ((s["share"] >= 1) & (d["gs"] > 0)) | ((s["share"] <= 0) & (d["gs"] < 0))
    det = d["haa"] * damp * d["hss"] * damp - d["has"] * d["has"]
    alone_a, alone_s = F.try_divide(d["ga"], d["haa"] * damp), F.try_divide(d["gs"], d["hss"] * damp)
    both_a = F.try_divide(d["ga"] * d["hss"] * damp - d["gs"] * d["has"], det)
    both_s = F.try_divide(d["gs"] * d["haa"] * damp - d["ga"] * d["has"], det)
    by_a = F.when(stuck_a, 0.0).when(stuck_s, alone_a).otherwise(F.coalesce(both_a, alone_a))
    by_s = F.when(stuck_s, 0.0).when(stuck_a, alone_s).otherwise(F.coalesce(both_s, alone_s))
    a = F.least(F.lit(1.0), F.greatest(F.lit(_LEAST_ALPHA), s["alpha"] + F.coalesce(by_a, F.lit(0.0))))
    g = F.least(F.lit(1.0), F.greatest(F.lit(0.0), s["share"] + F.coalesce(by_s, F.lit(0.0))))
    return F.struct(a.alias("alpha"), g.alias("share"))


def _descend(pts: Column, start: Column, rounds: int) -> Column:
    """``rounds`` damped Gauss-Newton steps over alpha and share; the initial state is
    solved for at every point, and a point that is no better only raises the damping."""
    def state(at, fit, damp):
        return F.struct(at["alpha"].alias("alpha"), at["share"].alias("share"), fit["l0"].alias("l0"), fit["b0"].alias("b0"),
                        fit["sse"].alias("sse"), fit["level"].alias("level"), fit["trend"].alias("trend"), damp.alias("damp"))

    def step(s, _):
        def tried(at):
            return _bind(_holt_pass(pts, at["alpha"], at["alpha"] * at["share"]), lambda fit: F.when(
                fit["sse"] < s["sse"], state(at, fit, F.greatest(s["damp"] / 4, F.lit(1e-9)))).otherwise(
                state(s, s, s["damp"] * 4)))
        return _bind(_bind(_slopes(pts, s), lambda d: _moved(s, d)), tried)
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)


#: Grid points, starts and steps of the iterative fit; its folds over a series.
_COARSE, _SHARES, _STARTS, _ROUNDS = 10, 5, 4, 24
ITERATIVE_FOLDS = _COARSE * (_SHARES + 1) + 2 * _STARTS * _ROUNDS


def holt_fit_iterative(series: DataFrame, keys=(), period: str = "year_month", value: str = "order_count") -> DataFrame:
    """FC2 by iterative least squares: the columns of :func:`holt_fit`. A coarse grid
    gives the best few starts of a key, each is improved by damped Gauss-Newton steps whose
    derivatives one fold carries, and the best end counts: 252 folds over a series in
    place of 5,591, and parameters that are not bound to a grid."""
    keys = list(keys)
    arr = series_arrays(series, keys, period, value)
    coarse = (arr.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(_COARSE))))
              .withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(_SHARES)))))
    a, g = F.col("_i") / _COARSE, F.col("_j") / _SHARES
    tried = coarse.select(*keys, "last_period", "pts", a.alias("alpha"), g.alias("share"),
                          F.inline(F.array(_holt_pass(F.col("pts"), a, a * g)))).filter("sse IS NOT NULL")
    one = F.struct("sse", "alpha", "share", "l0", "b0", "level", "trend")
    # at most 60 rows a key, all with its array of one element a month
    starts = tried.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list(one)), 1, _STARTS).alias("s"),
                                      F.first("pts").alias("pts"), F.first("last_period").alias("last_period"))
    starts = starts.select(*keys, "pts", "last_period", F.explode("s").alias("s"))
    first = F.struct(*[F.col(f"s.{n}").alias(n) for n in ("alpha", "share", "l0", "b0", "sse", "level", "trend")],
                     F.lit(0.01).alias("damp"))
    ends = starts.select(*keys, "last_period", F.inline(F.array(_descend(F.col("pts"), first, _ROUNDS))))
    ends = ends.withColumn("beta", F.col("alpha") * F.col("share"))
    return _every_key(arr, _best(ends, keys), keys)


def _every_key(arr: DataFrame, fit: DataFrame, keys) -> DataFrame:
    """``fit`` with a row of NULLs for every key that has none."""
    if not keys:
        return fit
    have = fit.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in fit.columns if c not in [*keys, "last_period"]])
    every = arr.select(*keys, "last_period")
    return every.join(have, _same_keys(every, have, keys), "left").select(*fit.columns)


def forecast_rows(fit: DataFrame, keys=(), horizon: int = 3) -> DataFrame:
    """FC4: level + h * trend for h = 1..horizon, half-even rounded to an int,
    labelled with the following months (yyyy-MM); NULL where nothing was fitted."""
    keys = list(keys)
    h = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")
    f = fit.select(*keys, "last_period", "level", "trend", h)
    month = F.date_format(F.add_months(F.to_date(F.concat("last_period", F.lit("-01"))),
                                       F.col("h")), "yyyy-MM")
    return f.select(*keys, month.alias("year_month"),
                    F.bround(F.col("level") + F.col("h") * F.col("trend"), 0)
                    .cast("bigint").alias("forecasted_order_count"))


def holt_forecast(series: DataFrame, horizon: int = 3, keys=(), iterative: bool = False, **kw) -> DataFrame:
    """FC2: fitted Holt forecast per key, by the grid or by iterative least squares."""
    return forecast_rows((holt_fit_iterative if iterative else holt_fit)(series, keys, **kw), keys, horizon)


def holt_fixed_fit(series: DataFrame, alpha: float, beta: float, keys=(),
                   period: str = "year_month", value: str = "order_count") -> DataFrame:
    """FC3: the same recursion with fixed smoothing and l0 = y0, b0 = y1 - y0."""
    keys = list(keys)
    arr = series_arrays(series, keys, period, value)
    if not keys:
        arr = arr.filter(F.size("pts") >= 2)
    a, bt = F.lit(float(alpha)), F.lit(float(beta))
    y0, y1 = F.col("pts")[0]["y"], F.get("pts", F.lit(1))["y"]      # one period: NULL trend and forecast
    init = F.struct(y0.alias("l"), (y1 - y0).alias("b"))

    def step(s, p):
        l2 = a * p["y"] + (1 - a) * (s["l"] + s["b"])
        return F.struct(l2.alias("l"), (bt * (l2 - s["l"]) + (1 - bt) * s["b"]).alias("b"))

    s = F.aggregate("pts", init, step)
    long_enough = F.size("pts") >= 2
    return arr.select(*keys, "last_period", F.when(long_enough, s["l"]).alias("level"),
                      F.when(long_enough, s["b"]).alias("trend"))


def volume_with_forecast(history: DataFrame, forecast: DataFrame, keys=()) -> DataFrame:
    """FC5: history and forecast in one table, tagged by kind."""
    keys = list(keys)
    return (history.select(*keys, "year_month", F.col("order_count").cast("bigint").alias("order_count"),
                           F.lit("actual").alias("kind"))
            .unionByName(forecast.select(*keys, "year_month",
                                         F.col("forecasted_order_count").alias("order_count"),
                                         F.lit("forecast").alias("kind"))))


def recent_periods(history: DataFrame, n: int = 6, period: str = "year_month") -> DataFrame:
    """TOP6: the last n periods of a (trimmed) history."""
    return history.orderBy(F.col(period).desc()).limit(n)
