"""Microstructure feature extractors and the feature pipeline.

Each extractor is ``(df, w, cfg) -> df``: it adds columns and silently
skips a feature whose input columns are absent. ``w`` orders one series; the
pipeline runs the extractors inside ``apply_ordered``, so all frames share one
exchange and one sort per series (or per chunk in chunked mode). Extractors of
this module share one window operator as well (``run_together``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..config import FeatureConfig, Ordering
from ..functions import frames as fr
from .ordered import apply_ordered

EPS = 1e-8   # fixed value: denominator guard used by the reference formulas

Extractor = Callable[[DataFrame, WindowSpec, FeatureConfig], DataFrame]


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


class Rows:
    """The rows around the current one as columns, and the columns made of them.

    Extractors that run together ask for what they read with ``at``, ``last`` and ``mean``;
    all of it is read by one window operator, at the cost of one pointer a distance. What
    they make is put down with ``add``, in layers: layer 0 sees the rows read, every layer
    the columns of the layers before it. Names that begin with ``_`` do not last."""

    def __init__(self, df: DataFrame, w: WindowSpec):
        self.types, self.w = dict(df.dtypes), w
        self.read: dict[str, Column] = {}
        self.layers: list[dict[str, Column]] = []
        self.names: list[str] = []

    def has(self, *cols: str) -> bool:
        return all(c in self.types for c in cols)

    def at(self, name: str, back: int) -> Column:
        """``name`` so many rows before the current one (after it, if below 0)."""
        if back == 0:
            return F.col(name)
        key = f"_{name}_{'lag' if back > 0 else 'lead'}_{abs(back)}"
        self.read[key] = (F.lag(name, back) if back > 0 else F.lead(name, -back)).over(self.w)
        return F.col(key)

    def last(self, name: str, n: int) -> list[Column]:
        """``name`` in the last ``n`` rows, the current one first."""
        return [self.at(name, k) for k in range(n)]

    def diff(self, name: str) -> Column:
        return F.col(name) - self.at(name, 1)

    def mean(self, name: str, n: int) -> Column:
        """``fr.rolling_mean``. A window aggregate would add up every frame anew, row by row."""
        if fr.by_lags(n) and self.types[name] == "double":
            return fr.mean_of(self.last(name, n))
        self.read[f"_{name}_mean_{n}"] = fr.rolling_mean(name, self.w, n)
        return F.col(f"_{name}_mean_{n}")

    def add(self, name: str, value: Column | None = None, layer: int = 0) -> None:
        """A column of the outcome, in the order of the calls; without ``value`` one that
        the row-wise part has made."""
        if not name.startswith("_"):
            self.names.append(name)
        if value is not None:
            self.add_layers([{}] * layer + [{name: value}])

    def add_layers(self, layers: Sequence[dict[str, Column]]) -> None:
        self.layers += [{} for _ in range(len(layers) - len(self.layers))]
        for mine, more in zip(self.layers, layers):
            mine.update(more)


class RowExtractor:
    """An extractor in two parts, so that several share one window operator: ``own(df, w,
    cfg)`` adds what a row gives by itself, ``around(rows, cfg)`` what its neighbours give."""

    def __init__(self, around, own=None):
        self.own, self.around = own or (lambda df, w, cfg: df), around
        self.__name__, self.__doc__ = around.__name__, around.__doc__

    def __call__(self, df: DataFrame, w: WindowSpec, cfg: FeatureConfig) -> DataFrame:
        return run_together([self], df, w, cfg)


def after(own):
    """Make an extractor of the decorated part and the row-wise part ``own`` before it."""
    return lambda around: RowExtractor(around, own)


def run_together(extractors: Sequence[RowExtractor], df: DataFrame, w: WindowSpec, cfg: FeatureConfig) -> DataFrame:
    """The columns that the extractors would add one after the other, by one window operator."""
    before = df.columns
    for ex in extractors:
        df = ex.own(df, w, cfg)
    rows = Rows(df, w)
    for ex in extractors:
        ex.around(rows, cfg)
    df = df.withColumns(rows.read) if rows.read else df
    for i, layer in enumerate(rows.layers):
        df = df.withColumns(layer) if layer else df
        df = df.drop(*rows.read) if i == 0 else df
    return df.select(*before, *[c for c in dict.fromkeys(rows.names) if c not in before])


def _own_ofi(df: DataFrame, w: WindowSpec, cfg: FeatureConfig) -> DataFrame:
    levels = {f"ofi_level_{i}": F.col(f"bid_size_{i}") - F.col(f"ask_size_{i}")
              for i in range(1, cfg.ofi_levels + 1) if _has(df, f"bid_size_{i}", f"ask_size_{i}")}
    return df.withColumns({**levels, "ofi_aggregate": fr.fold_sum([*levels.values()])}) if levels else df


@after(_own_ofi)
def ofi_features(rows: Rows, cfg: FeatureConfig) -> None:
    """PRJ5-6, WIN1-2: per-level size difference, its rolling mean and first difference."""
    levels = [f"ofi_level_{i}" for i in range(1, cfg.ofi_levels + 1) if rows.has(f"bid_size_{i}", f"ask_size_{i}")]
    for c in levels:
        rows.add(c)
        rows.add(f"{c}_rolling", rows.mean(c, cfg.ofi_window))
        rows.add(f"{c}_momentum", rows.diff(c))
    if levels:
        rows.add("ofi_aggregate")
        rows.add("ofi_aggregate_rolling", rows.mean("ofi_aggregate", cfg.ofi_window))


def _own_spread(df: DataFrame, w: WindowSpec, cfg: FeatureConfig) -> DataFrame:
    if not _has(df, "spread"):
        return df
    df = df.withColumn("spread_log", F.ln(F.col("spread") + F.lit(EPS)))
    if _has(df, "mid_price"):
        df = df.withColumn("spread_relative", fr.ratio("spread", "mid_price"))
    # a frame too long for lags is a window over this one
    return df if fr.by_lags(cfg.spread_window) else df.withColumn("spread_momentum", fr.diff("spread", w))


@after(_own_spread)
def spread_features(rows: Rows, cfg: FeatureConfig) -> None:
    """PRJ7-8, WIN3-7."""
    if not rows.has("spread"):
        return
    n = cfg.spread_window
    rows.add("spread_log")
    rows.add("spread_rolling_mean", rows.mean("spread", n))
    if n > 1 and fr.by_lags(n):
        # taken from the current value: a constant frame has no rounding errors
        off = {f"_spread_off_{k}": (c - F.col("spread")).cast("double") for k, c in enumerate(rows.last("spread", n))}
        rows.add_layers([off, {"_spread_off": fr.mean_of([F.col(c) for c in off])}])
        d = [F.col(c) - F.col("_spread_off") for c in reversed(off)]
        rows.add("spread_rolling_std", F.sqrt(fr.fold([x * x for x in d]) / F.lit(float(n - 1))), layer=2)
    else:
        rows.read["_spread_std"] = fr.rolling_std("spread", rows.w, n)
        rows.add("spread_rolling_std", F.col("_spread_std"))
    if rows.has("mid_price"):
        rows.add("spread_relative")
        rows.add("spread_relative_rolling", rows.mean("spread_relative", n))
    if fr.by_lags(n):
        at = [c.cast("double") for c in rows.last("spread", n + 1)]
        rows.add("spread_momentum", rows.diff("spread"))
        rows.add("spread_momentum_rolling", fr.mean_of([a - b for a, b in zip(at, at[1:])]))
    else:
        rows.add("spread_momentum")
        rows.add("spread_momentum_rolling", rows.mean("spread_momentum", n))


def _own_depth(df: DataFrame, w: WindowSpec, cfg: FeatureConfig) -> DataFrame:
    bids = [f"bid_size_{i}" for i in range(1, cfg.depth_levels + 1) if _has(df, f"bid_size_{i}")]
    asks = [f"ask_size_{i}" for i in range(1, cfg.depth_levels + 1) if _has(df, f"ask_size_{i}")]
    if not (bids and asks):
        return df
    df = df.withColumns({"total_bid_depth": fr.fold_sum(bids), "total_ask_depth": fr.fold_sum(asks)})
    df = df.withColumn("total_depth", F.col("total_bid_depth") + F.col("total_ask_depth"))
    return df.withColumn("depth_imbalance", fr.ratio(F.col("total_bid_depth") - F.col("total_ask_depth"),
                                                     "total_depth"))


@after(_own_depth)
def depth_features(rows: Rows, cfg: FeatureConfig) -> None:
    """PRJ9-10, WIN8-9."""
    if not all(any(rows.has(f"{side}_size_{i}") for i in range(1, cfg.depth_levels + 1)) for side in ("bid", "ask")):
        return
    for c in ("total_bid_depth", "total_ask_depth", "total_depth", "depth_imbalance"):
        rows.add(c)
    for c in ("total_depth", "depth_imbalance"):
        rows.add(f"{c}_rolling", rows.mean(c, cfg.depth_window))
    for c in ("total_depth", "depth_imbalance"):
        rows.add(f"{c}_momentum", rows.diff(c))


def imbalance_weights(k: int) -> list[float]:
    """Weights proportional to 1/rank over the k present levels, summing to 1."""
    raw = [1.0 / i for i in range(1, k + 1)]
    tot = sum(raw)
    return [x / tot for x in raw]


def _own_imbalance(df: DataFrame, w: WindowSpec, cfg: FeatureConfig) -> DataFrame:
    new = {}
    for i in range(1, cfg.imbalance_levels + 1):
        if _has(df, f"bid_size_{i}", f"ask_size_{i}"):
            b, a = F.col(f"bid_size_{i}"), F.col(f"ask_size_{i}")
            new[f"imbalance_level_{i}"] = (b - a) / (b + a + F.lit(EPS))
    if not new:
        return df
    wi = F.lit(0.0)
    for wt, c in zip(imbalance_weights(len(new)), new):
        wi = wi + F.lit(wt) * F.coalesce(F.col(c), F.lit(0.0))
    return df.withColumns(new).withColumn("weighted_imbalance", wi)


@after(_own_imbalance)
def imbalance_features(rows: Rows, cfg: FeatureConfig) -> None:
    """PRJ11-12, WIN10-11."""
    levels = [f"imbalance_level_{i}" for i in range(1, cfg.imbalance_levels + 1)
              if rows.has(f"bid_size_{i}", f"ask_size_{i}")]
    for c in [*levels, *(["weighted_imbalance"] if levels else [])]:
        rows.add(c)
        rows.add(f"{c}_rolling", rows.mean(c, cfg.imbalance_window))


def _own_vwap(df: DataFrame, w: WindowSpec, cfg: FeatureConfig) -> DataFrame:
    return df.withColumn("vwap", F.col("mid_price")) if _has(df, "mid_price", "total_depth") else df


@after(_own_vwap)
def vwap_features(rows: Rows, cfg: FeatureConfig) -> None:
    """PRJ13-14, WIN12-13. ``vwap`` is the mid price (the reference's simplification)."""
    if not rows.has("mid_price", "total_depth"):
        return
    n = cfg.vwap_window
    rows.add("vwap")
    rows.add("vwap_rolling", rows.mean("mid_price", n))
    rows.add("vwap_momentum", rows.diff("mid_price"))
    if cfg.vwap_volume:
        fw = fr.frame(rows.w, n)
        pv = F.col("mid_price") * F.col("total_depth")
        rows.read["_vwap_volume"] = F.when(
            F.count(pv).over(fw) == n, fr.ratio(F.sum(pv).over(fw), F.sum("total_depth").over(fw)))
        rows.add("vwap_volume", F.col("_vwap_volume"))
    dev = F.col("mid_price") - F.col("vwap_rolling")
    rows.add("vwap_deviation", dev, layer=1)
    rows.add("vwap_deviation_abs", F.abs(dev), layer=1)


def _own_return(df: DataFrame, w: WindowSpec, cfg: FeatureConfig) -> DataFrame:
    # frames too long for lags are windows over this one
    long = any(n > fr.MAX_LAGS for n in cfg.return_windows)
    return df.withColumn("_r1", fr.pct_change("mid_price", w)) if long and _has(df, "mid_price") else df


@after(_own_return)
def return_features(rows: Rows, cfg: FeatureConfig) -> None:
    """WIN14-19: forward/backward returns and rolling moments of 1-step returns."""
    if not rows.has("mid_price"):
        return
    mid = F.col("mid_price")
    short = [n for n in cfg.return_windows if 1 < n <= fr.MAX_LAGS]
    at = rows.last("mid_price", max(short) + 1) if short else []
    r1 = {f"__r1_lag_{k}": fr.ratio(a, b) - F.lit(1.0) for k, (a, b) in enumerate(zip(at, at[1:]))}
    moments = fr.moment_layers("_r1", [*r1], short)
    rows.add_layers([r1, *moments])
    last = len(moments) + 1

    def moment(name: str, n: int, by_layers, by_window) -> None:
        if n in short:
            rows.add(name, by_layers("_r1", n), layer=last)
        elif n <= fr.MAX_LAGS:      # one row has no moments
            rows.add(name, F.lit(None).cast("double"))
        else:
            rows.read[f"__r1_{name}"] = by_window("_r1", rows.w, n)
            rows.add(name, F.col(f"__r1_{name}"))

    for n in cfg.return_windows:
        rows.add(f"return_forward_{n}", fr.ratio(rows.at("mid_price", -n), mid) - F.lit(1.0))
        rows.add(f"return_backward_{n}", fr.ratio(mid, rows.at("mid_price", n)) - F.lit(1.0))
        if not cfg.model_ready or n >= 2:
            moment(f"volatility_{n}", n, fr.moment_std, fr.rolling_std)
        if not cfg.model_ready or n >= 3:
            moment(f"skewness_{n}", n, fr.moment_skew, fr.rolling_skew)
        if not cfg.model_ready or n >= 4:
            moment(f"kurtosis_{n}", n, fr.moment_kurt, fr.rolling_kurt)


def _own_microprice(df: DataFrame, w: WindowSpec, cfg: FeatureConfig) -> DataFrame:
    if not _has(df, *_TOP):
        return df
    bp, ap, bs, as_ = (F.col(c) for c in ("bid_price_1", "ask_price_1", "bid_size_1", "ask_size_1"))
    return df.withColumn("microprice", (bp * as_ + ap * bs) / (bs + as_ + F.lit(EPS)))


_TOP = ("bid_size_1", "ask_size_1", "bid_price_1", "ask_price_1")


@after(_own_microprice)
def microprice_features(rows: Rows, cfg: FeatureConfig) -> None:
    """PRJ15-16, WIN20."""
    if not rows.has(*_TOP):
        return
    rows.add("microprice")
    rows.add("microprice_rolling", rows.mean("microprice", cfg.microprice_window))
    if rows.has("mid_price"):
        dev = F.col("microprice") - F.col("mid_price")
        rows.add("microprice_deviation", dev)
        rows.add("microprice_deviation_abs", F.abs(dev))


DEFAULT_EXTRACTORS: tuple[Extractor, ...] = (
    ofi_features, spread_features, depth_features, imbalance_features,
    vwap_features, return_features, microprice_features,
)


def reads(back: int = 0, ahead: int = 0):
    """Declare how many rows before and after the current one an extractor reads."""
    def mark(extractor: Extractor) -> Extractor:
        extractor.reads = (back, ahead)
        return extractor
    return mark


def depth(extractors: Sequence[Extractor], cfg: FeatureConfig, o: Ordering) -> tuple[int, int]:
    """Rows of halo the extractors need. Extractors run one after the other on the
    same frame, so depths of declared ones add up."""
    back, ahead = cfg.lookback(), cfg.lookahead()
    for ex in extractors:
        if ex in DEFAULT_EXTRACTORS:
            continue
        if not hasattr(ex, "reads"):
            if o.chunk_rows is None:
                continue
            raise ValueError(f"extractor {getattr(ex, '__name__', ex)!r} does not say how many rows it reads; "
                             "declare it with reads(back, ahead)")
        back, ahead = back + ex.reads[0], ahead + ex.reads[1]
    return back, ahead


def null_out_non_finite(df: DataFrame) -> DataFrame:
    """PRJ17: NaN and +-inf become NULL in every floating column."""
    # one parsed expression a column: built from Column calls, the hundred or so columns
    # of the feature table take the driver seconds
    def clean(name: str) -> str:
        c = "`" + name.replace("`", "``") + "`"
        return f"if(isnan({c}) or abs({c}) = cast('infinity' as double), null, {c}) as {c}"

    if not any(isinstance(f.dataType, (DoubleType, FloatType)) for f in df.schema.fields):
        return df
    return df.selectExpr(*[clean(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
                           else "`" + f.name.replace("`", "``") + "`" for f in df.schema.fields])


def feature_pipeline(df: DataFrame, cfg: FeatureConfig = FeatureConfig(),
                     ordering: Ordering = Ordering(),
                     extractors: Sequence[Extractor] = DEFAULT_EXTRACTORS) -> DataFrame:
    """WIN27: run the extractors in order (VWAP needs depth first), then PRJ17.

    Extractors of this module are served by the configuration's depths; any other
    has to be declared with ``reads(back, ahead)``, the rows before and after the
    current one that it reads.
    """
    def build(frame: DataFrame, w: WindowSpec) -> DataFrame:
        for together, some in groupby(extractors, lambda ex: isinstance(ex, RowExtractor)):
            if together:
                frame = run_together([*some], frame, w, cfg)
            else:
                for ex in some:
                    frame = ex(frame, w, cfg)
        return frame
    out = apply_ordered(df, ordering, build, *depth(extractors, cfg, ordering))
    return null_out_non_finite(out)


def extract_one(df: DataFrame, extractor: Extractor, cfg: FeatureConfig = FeatureConfig(),
                ordering: Ordering = Ordering()) -> DataFrame:
    """Run a single extractor (its own window layout)."""
    return apply_ordered(df, ordering, lambda f, w: extractor(f, w, cfg),
                         *depth([extractor], cfg, ordering))


NON_FEATURES = ("symbol", "ts", "seq", "timestamp", "label", "pos", "split", "fold")


def feature_columns(df: DataFrame, leaky: bool = False, exclude: Sequence[str] = ()) -> list[str]:
    """PRJ18/PRJ20: numeric model inputs, derived from the plan's schema.

    Leaves out keys, time, label, probability/prediction columns and, unless
    ``leaky``, the forward returns the label is made from.
    """
    skip = set(NON_FEATURES) | set(exclude) | {"prob_up", "prob_down", "prob_flat", "prediction"}
    out = []
    for f in df.schema.fields:
        if f.name in skip or not isinstance(f.dataType, (DoubleType, FloatType)):
            continue
        if not leaky and f.name.startswith("return_forward_"):
            continue
        out.append(f.name)
    return out


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """FLT2: drop rows with a null or NaN in any of ``subset`` (all feature columns by default).

    Complete rows are numbered first: a filter on the columns themselves would be moved below
    the projections that make them, and make every feature a second time there."""
    def known(f) -> str:
        c = "`" + f.name.replace("`", "``") + "`"
        return f"{c} is not null" + (f" and not isnan({c})" if isinstance(f.dataType, (DoubleType, FloatType)) else "")

    names = set(subset or feature_columns(df))
    all_known = " and ".join(known(f) for f in df.schema.fields if f.name in names) or "true"
    numbered = df.withColumn("_complete", F.when(F.expr(all_known), F.monotonically_increasing_id()))
    return numbered.filter(F.col("_complete").isNotNull()).drop("_complete")
