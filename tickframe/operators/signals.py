"""Signals from class probabilities, position sizing and threshold search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SignalConfig

# The reference's threshold grid, np.arange(0.5, 0.9, 0.05) and
# np.arange(0.1, 0.5, 0.05), written out exactly as those float64 values.
LONG_GRID = (0.5, 0.55, 0.6000000000000001, 0.6500000000000001, 0.7000000000000002,
             0.7500000000000002, 0.8000000000000003, 0.8500000000000003)
SHORT_GRID = (0.1, 0.15000000000000002, 0.20000000000000004, 0.25000000000000006,
              0.30000000000000004, 0.3500000000000001, 0.40000000000000013, 0.45000000000000007)
DEFAULT_WIN_PROB = 0.55
DEFAULT_ODDS = 1.0


def known(c: Column) -> Column:
    """A probability, NULL where it is NaN (Spark orders NaN above every number)."""
    return F.when(~F.isnan(c.cast("double")), c)


def signal_ternary(up: Column, down: Column, long_t: float, short_t: float) -> Column:
    """SIG1: short wins when both rules fire; NULL when a probability is NULL or NaN and no rule fired."""
    up, down = known(up), known(down)
    return (F.when(down > F.lit(short_t), F.lit(-1)).when(up > F.lit(long_t), F.lit(1))
            .when((up <= F.lit(long_t)) & (down <= F.lit(short_t)), F.lit(0)))


def signal_binary(up: Column, long_t: float, short_t: float) -> Column:
    """SIG2: +1 above long, -1 below short (short wins), 0 within, NULL for NULL or NaN."""
    up = known(up)
    return (F.when(up < F.lit(short_t), F.lit(-1)).when(up > F.lit(long_t), F.lit(1))
            .when((up >= F.lit(short_t)) & (up <= F.lit(long_t)), F.lit(0)))


def generate_signals(df: DataFrame, cfg: SignalConfig = SignalConfig(), *keys: str) -> DataFrame:
    """SIG3 dispatch + sizing: adds ``signal`` (INT) and ``position_size``."""
    if "prob_up" in df.columns and "prob_down" in df.columns:
        sig = signal_ternary(F.col("prob_up"), F.col("prob_down"),
                             cfg.long_threshold, cfg.short_threshold)
    elif "prob_up" in df.columns:
        sig = signal_binary(F.col("prob_up"), cfg.long_threshold, cfg.short_threshold)
    else:
        raise ValueError("DataFrame must contain probability columns")
    df = df.withColumn("signal", sig)
    if cfg.position_sizing == "fixed":
        return df.withColumn("position_size", size_fixed(F.col("signal"), cfg.position_size))
    if cfg.position_sizing == "kelly":
        return size_kelly(df, cfg, *keys)
    raise ValueError(f"Unknown position sizing method: {cfg.position_sizing}")


def size_fixed(signal: Column, size: float) -> Column:
    """SIG4."""
    return F.abs(signal).cast("double") * F.lit(float(size))


def win_probability_expr(signal: Column | None = None, ret: Column | None = None) -> Column:
    """SIG6 as an aggregate: share of all rows where the signal's side was right."""
    signal = F.col("signal") if signal is None else signal
    ret = F.col("return_forward_1") if ret is None else ret
    win = ((signal > 0) & (ret > 0)) | ((signal < 0) & (ret < 0))
    return F.avg(F.when(win, F.lit(1.0)).otherwise(F.lit(0.0)))


def odds_expr(ret: Column | None = None) -> Column:
    """SIG7 as an aggregate: 1 / mean |r| when that mean is > 0, else 1.0."""
    ret = F.col("return_forward_1") if ret is None else ret
    m = F.avg(F.abs(ret))
    return F.when(m > 0, F.lit(1.0) / m).otherwise(F.lit(DEFAULT_ODDS))


def kelly_fraction_expr(p: Column, odds: Column, cap: float) -> Column:
    k = p - (F.lit(1.0) - p) / odds
    return F.greatest(F.lit(0.0), F.least(k, F.lit(cap)))


def size_kelly(df: DataFrame, cfg: SignalConfig, *keys: str) -> DataFrame:
    """SIG5: |signal| * clamp(p - (1-p)/odds, 0, kelly_fraction) * position_size.

    p and odds are one aggregate per key (one row per key), joined back.
    Without ``return_forward_1`` the reference's defaults 0.55 and 1.0 apply.
    """
    if "return_forward_1" in df.columns:
        est = df.groupBy(*keys).agg(win_probability_expr().alias("_p"), odds_expr().alias("_o"))
        est = est.withColumn("_kf", kelly_fraction_expr(F.col("_p"), F.col("_o"), cfg.kelly_fraction))
        if keys:
            df = df.join(est.select(*keys, "_kf"), list(keys), "left")
        else:
            # a global aggregate is exactly one row: a proven size bound
            one = est.select(F.lit(1).alias("_one"), "_kf")
            df = df.withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one").drop("_one")
        kf = F.col("_kf")
    else:
        kf = kelly_fraction_expr(F.lit(DEFAULT_WIN_PROB), F.lit(DEFAULT_ODDS), cfg.kelly_fraction)
    out = df.withColumn("position_size",
                        F.abs(F.col("signal")).cast("double") * kf * F.lit(cfg.position_size))
    return out.drop("_kf") if "_kf" in out.columns else out


def signal_distribution(df: DataFrame, *keys: str) -> DataFrame:
    """SIG8: rows per signal value."""
    return df.groupBy(*keys, "signal").agg(F.count(F.lit(1)).alias("n"))


def signal_events(df: DataFrame, side: int) -> DataFrame:
    """FLT6: rows where the signal is ``side`` (1 buy, -1 sell)."""
    return df.filter(F.col("signal") == F.lit(side))


# --------------------------------------------------------------- OPT1-4

def _cell_index(p: Column, grid: tuple[float, ...], strict: bool = True) -> Column:
    """How many grid thresholds ``p`` exceeds (``>``, or ``>=``); -1 for NULL."""
    n = F.lit(0)
    for g in grid:
        hit = p > F.lit(g) if strict else p >= F.lit(g)
        n = n + F.when(hit, F.lit(1)).otherwise(F.lit(0))
    return F.when(p.isNull(), F.lit(-1)).otherwise(n)


def optimize_thresholds(df: DataFrame, metric: str = "sharpe", *keys: str,
                        ret: str = "return_forward_1") -> DataFrame:
    """OPT1-4 + TOP2: best (long, short) pair of the 8x8 grid per key, in ONE pass.

    Instead of rebuilding the signal table for 64 threshold pairs, every row is
    put in a cell by the number of long / short thresholds its probabilities
    exceed (9 x 9 cells plus NULL cells). One aggregate collects per cell the
    counts and sums the metrics need (map-side combined, so a hot key costs
    nothing extra); each of the few cell rows is then expanded to the 64 grid
    points and scored. Ties go to the first pair in long-then-short order, as
    in the reference's strict ``>`` scan.
    """
    if metric not in ("sharpe", "sortino", "hit_rate"):
        raise ValueError(f"Unknown metric: {metric}")
    if ret not in df.columns:
        raise ValueError(f"DataFrame must contain '{ret}' column")
    ternary = "prob_down" in df.columns
    up = known(F.col("prob_up"))
    r = F.col("r")
    parts = {"all": r, "pos": F.when(r > 0, r), "neg": F.when(r < 0, r)}
    cells = df.select(
        *keys,
        _cell_index(up, LONG_GRID).alias("cu"),
        (_cell_index(known(F.col("prob_down")), SHORT_GRID) if ternary
         else _cell_index(up, SHORT_GRID, strict=False)).alias("cd"),
        known(F.col(ret)).alias("r"),
    ).groupBy(*keys, "cu", "cd").agg(
        F.count(F.lit(1)).alias("n"),
        # count, mean and squared deviations of the returns, the gains and the losses
        *[f(x).alias(f"{a}_{p}") for p, x in parts.items() for a, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))],
    )
    idx = F.sequence(F.lit(0), F.lit(len(LONG_GRID) - 1))
    points = (cells.withColumn("li", F.explode(idx)).withColumn("si", F.explode(idx))
              .withColumns({
                  "long_threshold": F.element_at(F.array(*[F.lit(x) for x in LONG_GRID]),
                                                 F.col("li") + 1),
                  "short_threshold": F.element_at(F.array(*[F.lit(x) for x in SHORT_GRID]),
                                                  F.col("si") + 1)}))
    # cell index k means "p exceeds thresholds 0..k-1": p > grid[i] iff k > i
    cu, cd = F.col("cu"), F.col("cd")
    is_long = cu > F.col("li")
    if ternary:
        sig = (F.when(cd > F.col("si"), F.lit(-1)).when(is_long, F.lit(1))
               .when((cu >= 0) & (cd >= 0), F.lit(0)))
    else:
        # prob_up < s  <=>  p is not >= s  <=>  (>=)-count k <= i
        sig = (F.when((cd >= 0) & (cd <= F.col("si")), F.lit(-1)).when(is_long, F.lit(1))
               .when(cu >= 0, F.lit(0)))
    points = points.withColumn("s", sig)
    s = F.col("s")
    # x = s * r: all returns with the side's sign (none counts as 0), and those below 0,
    # which are the losses of a long and the gains of a short
    side = F.when(s == 1, F.lit("neg")).when(s == -1, F.lit("pos"))
    points = points.withColumns({
        "nx": F.when(s.isNotNull(), F.col("n_all")).otherwise(0), "mx": s * F.coalesce("m_all", F.lit(0.0)),
        "vx": s * s * F.coalesce("v_all", F.lit(0.0)),
        "nn": F.coalesce(F.when(side == "neg", F.col("n_neg")).when(side == "pos", F.col("n_pos")), F.lit(0)),
        "mn": F.coalesce(F.when(side == "neg", F.col("m_neg")).when(side == "pos", -F.col("m_pos")), F.lit(0.0)),
        "vn": F.coalesce(F.when(side == "neg", F.col("v_neg")).when(side == "pos", F.col("v_pos")), F.lit(0.0)),
        "w": F.when(s == 1, F.col("n_pos")).when(s == -1, F.col("n_neg")).otherwise(0)})
    # cells are merged about their common mean, so a mean that is large against the
    # spread costs no digits
    group = [*keys, "li", "si"]
    wg = Window.partitionBy(*group)
    for k in ("x", "n"):
        size, mean = F.col(f"n{k}"), F.coalesce(F.col(f"m{k}"), F.lit(0.0))
        points = points.withColumn(f"c{k}", F.try_divide(F.sum(size * mean).over(wg), F.sum(size).over(wg)))
    per_point = points.groupBy(*group, "long_threshold", "short_threshold").agg(
        F.sum("n").alias("N"), F.sum("w").alias("w"),
        *[x for k in ("x", "n") for x in (
            F.sum(f"n{k}").alias(f"n{k}"), F.max(f"c{k}").alias(f"c{k}"),
            F.sum(F.col(f"n{k}") * (F.col(f"v{k}") + (F.col(f"m{k}") - F.col(f"c{k}")) ** 2)).alias(f"d{k}"))])
    scored = per_point.withColumn("score", _score(metric))
    order = [F.col("score").desc_nulls_last(), F.col("li"), F.col("si")]
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    best = scored.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1)
    return best.select(*keys, "long_threshold", "short_threshold", "score")


def _std(n: Column, squares: Column) -> Column:
    """Sample standard deviation from the count and the squared deviations."""
    return F.when(n > 1, F.sqrt(squares / (n - F.lit(1))))


def _score(metric: str) -> Column:
    if metric == "hit_rate":
        return F.try_divide(F.col("w").cast("double"), F.col("N").cast("double"))
    sd = _std(F.col("nx"), F.col("dx")) if metric == "sharpe" else _std(F.col("nn"), F.col("dn"))
    return F.when(sd > 0, F.try_divide(F.col("cx"), sd)).otherwise(F.lit(0.0))
