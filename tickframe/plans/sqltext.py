"""SQL text of the oracle twins (DuckDB dialect, ANSI window functions).

The oracle is written independently of the DataFrame code: plain SQL over the
``events`` view, run by DuckDB. Feature SQL is generated from the same
``FeatureConfig`` values so both sides use identical windows.
"""

from __future__ import annotations

from ..config import FeatureConfig
from ..operators.features import EPS, imbalance_weights
from ..sources.book import book_basics_sql

W = "PARTITION BY symbol ORDER BY ts, seq"


def dlit(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def frame(n: int, part: str = W) -> str:
    return f"({part} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(agg: str, x: str, n: int, part: str = W) -> str:
    f = frame(n, part)
    return f"CASE WHEN count({x}) OVER {f} = {n} THEN {agg}({x}) OVER {f} END"


def lag(x: str, k: int = 1, part: str = W) -> str:
    return f"lag({x}, {k}) OVER ({part})"


def lead(x: str, k: int = 1, part: str = W) -> str:
    return f"lead({x}, {k}) OVER ({part})"


def div(a: str, b: str) -> str:
    return f"(({a}) / NULLIF({b}, 0))"


def skew(x: str, n: int, part: str = W) -> str:
    if n < 3:
        return "CAST(NULL AS DOUBLE)"
    f = frame(n, part)
    return (f"CASE WHEN count({x}) OVER {f} < {n} THEN NULL "
            f"WHEN max({x}) OVER {f} = min({x}) OVER {f} THEN {dlit(0.0)} "
            f"WHEN var_pop({x}) OVER {f} <= {dlit(1e-14)} THEN NULL "
            f"ELSE skewness({x}) OVER {f} END")


def kurt(x: str, n: int, part: str = W) -> str:
    if n < 4:
        return "CAST(NULL AS DOUBLE)"
    f = frame(n, part)
    return (f"CASE WHEN count({x}) OVER {f} < {n} THEN NULL "
            f"WHEN max({x}) OVER {f} = min({x}) OVER {f} THEN {dlit(-3.0)} "
            f"WHEN var_pop({x}) OVER {f} <= {dlit(1e-14)} THEN NULL "
            f"ELSE kurtosis({x}) OVER {f} END")


def coalesce_sum(cols: list[str]) -> str:
    return " + ".join(f"COALESCE({c}, {dlit(0.0)})" for c in cols)


def book_cte() -> str:
    return f"book AS ({book_basics_sql()})"


def features_sql(cfg: FeatureConfig = FeatureConfig(), src: str = "book") -> str:
    """All seven extractors in three layers of SELECTs (window over window)."""
    L = 5
    l1 = ["*"]
    ofi = [f"(bid_size_{i} - ask_size_{i})" for i in range(1, cfg.ofi_levels + 1) if i <= L]
    for i, e in enumerate(ofi, 1):
        l1.append(f"{e} AS ofi_level_{i}")
    l1.append(f"{coalesce_sum(ofi)} AS ofi_aggregate")
    l1 += [f"ln(spread + {dlit(EPS)}) AS spread_log",
           f"{div('spread', 'mid_price')} AS spread_relative",
           f"spread - {lag('spread')} AS spread_momentum"]
    bids = [f"bid_size_{i}" for i in range(1, cfg.depth_levels + 1) if i <= L]
    asks = [f"ask_size_{i}" for i in range(1, cfg.depth_levels + 1) if i <= L]
    l1 += [f"{coalesce_sum(bids)} AS total_bid_depth", f"{coalesce_sum(asks)} AS total_ask_depth"]
    imb = []
    for i in range(1, cfg.imbalance_levels + 1):
        if i <= L:
            l1.append(f"(bid_size_{i} - ask_size_{i}) / (bid_size_{i} + ask_size_{i} + {dlit(EPS)})"
                      f" AS imbalance_level_{i}")
            imb.append(f"imbalance_level_{i}")
    l1 += ["mid_price AS vwap",
           f"(bid_price_1 * ask_size_1 + ask_price_1 * bid_size_1) / (bid_size_1 + ask_size_1 + "
           f"{dlit(EPS)}) AS microprice",
           f"{div('mid_price', lag('mid_price'))} - {dlit(1.0)} AS _r1"]
    # layer 2: derived from layer 1
    l2 = ["*", "total_bid_depth + total_ask_depth AS total_depth",
          f"{div('total_bid_depth - total_ask_depth', 'total_bid_depth + total_ask_depth')}"
          f" AS depth_imbalance"]
    wts = imbalance_weights(len(imb))
    wi = dlit(0.0) + "".join(f" + {dlit(w)} * COALESCE({c}, {dlit(0.0)})" for w, c in zip(wts, imb))
    l2.append(f"{wi} AS weighted_imbalance")
    l2 += ["microprice - mid_price AS microprice_deviation",
           "abs(microprice - mid_price) AS microprice_deviation_abs"]
    # layer 3: windows
    n = cfg.ofi_window
    l3 = ["*"]
    for i in range(1, len(ofi) + 1):
        l3 += [f"{full('avg', f'ofi_level_{i}', n)} AS ofi_level_{i}_rolling",
               f"ofi_level_{i} - {lag(f'ofi_level_{i}')} AS ofi_level_{i}_momentum"]
    l3.append(f"{full('avg', 'ofi_aggregate', n)} AS ofi_aggregate_rolling")
    s = cfg.spread_window
    l3 += [f"{full('avg', 'spread', s)} AS spread_rolling_mean",
           f"{full('stddev_samp', 'spread', s)} AS spread_rolling_std",
           f"{full('avg', 'spread_relative', s)} AS spread_relative_rolling",
           f"{full('avg', 'spread_momentum', s)} AS spread_momentum_rolling"]
    d = cfg.depth_window
    l3 += [f"{full('avg', 'total_depth', d)} AS total_depth_rolling",
           f"{full('avg', 'depth_imbalance', d)} AS depth_imbalance_rolling",
           f"total_depth - {lag('total_depth')} AS total_depth_momentum",
           f"depth_imbalance - {lag('depth_imbalance')} AS depth_imbalance_momentum"]
    m = cfg.imbalance_window
    for c in imb:
        l3.append(f"{full('avg', c, m)} AS {c}_rolling")
    l3.append(f"{full('avg', 'weighted_imbalance', m)} AS weighted_imbalance_rolling")
    v = cfg.vwap_window
    l3 += [f"{full('avg', 'vwap', v)} AS vwap_rolling", f"vwap - {lag('vwap')} AS vwap_momentum"]
    for k in cfg.return_windows:
        l3 += [f"{div(lead('mid_price', k), 'mid_price')} - {dlit(1.0)} AS return_forward_{k}",
               f"{div('mid_price', lag('mid_price', k))} - {dlit(1.0)} AS return_backward_{k}"]
        if not cfg.model_ready or k >= 2:
            l3.append(f"{full('stddev_samp', '_r1', k)} AS volatility_{k}")
        if not cfg.model_ready or k >= 3:
            l3.append(f"{skew('_r1', k)} AS skewness_{k}")
        if not cfg.model_ready or k >= 4:
            l3.append(f"{kurt('_r1', k)} AS kurtosis_{k}")
    l3.append(f"{full('avg', 'microprice', cfg.microprice_window)} AS microprice_rolling")
    l4 = ["* EXCLUDE (_r1)", "mid_price - vwap_rolling AS vwap_deviation",
          "abs(mid_price - vwap_rolling) AS vwap_deviation_abs"]
    sel = lambda cols: ",\n  ".join(cols)
    return (f"SELECT {sel(l4)} FROM (SELECT {sel(l3)} FROM (SELECT {sel(l2)} FROM "
            f"(SELECT {sel(l1)} FROM {src}) f1) f2) f3")


def label_sql(h: int = 1, theta: float = 0.001, method: str = "ternary", part: str = W) -> str:
    r = f"(({lead('mid_price', h, part)} - mid_price) / NULLIF(mid_price, 0))"
    t = dlit(theta)
    if method == "ternary":
        return (f"CASE WHEN {r} > {t} THEN 2 WHEN {r} < -{t} THEN 0 "
                f"WHEN {r} >= -{t} AND {r} <= {t} THEN 1 END")
    return f"CASE WHEN {r} > 0 THEN 1 WHEN {r} <= 0 THEN 0 END"
