"""Dead-band ledger, sliding frames, even cells, and the flow from fit to ledger."""

import math
import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickframe.config import ExecutionConfig, ModelConfig, Ordering
from tickframe.operators import deadband, evaluation, ledger, metrics, ordered, quantiles, signals, training
from tickframe.operators.cells import even_cells
from tickframe.operators.sliding import sliding_frames

KEYED, CHUNKED = Ordering(), Ordering(chunk_rows=60)
T0 = datetime(2024, 1, 1)


def series(rng, n, symbols="ab", gap=600.0):
    rows = []
    for s in [*symbols, None]:
        t = T0
        for i in range(n):
            t += timedelta(seconds=rng.random() * gap)
            rows.append((s, None if i < 2 and s == "a" else t, i, rng.choice([-1, 0, 1, 1, 1, None]),
                         rng.choice([0.5, 1.0, 1.0, 1.05, 1.12, 1.2, rng.random()]),
                         None if rng.random() < 0.05 else 100 + rng.random()))
    rng.shuffle(rows)
    return rows


SCHEMA = "symbol string, ts timestamp_ntz, seq long, signal int, position_size double, mid_price double"


# ------------------------------------------------------------------ dead band

def test_band_maps_compose_like_the_loop():
    rng = random.Random(1)
    for _ in range(400):
        targets = [round(rng.uniform(-1, 1) * rng.choice([0.2, 1]), 3) for _ in range(rng.randrange(0, 30))]
        m = rng.choice([0.05, 0.1, 0.5, 3.0])
        cut = rng.randrange(len(targets) + 1)
        for p in (0.0, rng.uniform(-1, 1), *(targets[:2])):
            end = (deadband.replay(p, targets, m) or [p])[-1]
            assert deadband.through(p, *deadband.band_map(targets, m), m) == end
            half = deadband.through(p, *deadband.band_map(targets[:cut], m), m)
            assert deadband.through(half, *deadband.band_map(targets[cut:], m), m) == end


def loop(rows, m, big, delay):
    """Position after each row, by the plain loop of one series."""
    out, p = {}, 0.0
    for i, r in enumerate(rows):
        x = rows[i - delay] if i >= delay else None
        if x is not None and x[3] is not None:
            c = max(-big, min(big, float(x[3]) * x[4]))
            if abs(c - p) >= m:
                p = c
        out[r[2]] = p
    return out


@pytest.mark.parametrize("mode,delay", [("reference", 1), ("mtm", 1), ("mtm", 3), ("mtm", 0)])
def test_dead_band_equals_the_loop(spark, mode, delay):
    rng = random.Random(delay)
    rows = series(rng, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    cfg = ExecutionConfig(mode=mode, execution_delay=delay, dead_band=True, max_position=1.1)
    want = {}
    for s in ("a", "b", None):
        mine = sorted((r for r in rows if r[0] == s), key=lambda r: (r[1] is not None, r[1] or T0, r[2]))
        want |= {(s, k): v for k, v in loop(mine, 0.1, 1.1, delay if mode == "mtm" else 0).items()}
    results = []
    for o in (KEYED, CHUNKED):
        got = ledger.execute_trades(df, cfg, o).collect()
        assert len(got) == len(rows)
        if mode == "mtm":
            assert {(r.symbol, r.seq): r.position for r in got} == want
        else:
            assert all(r.position == want[r.symbol, r.seq] for r in got if r.executed)
            last = dict.fromkeys(["a", "b", None], 0.0)
            for r in sorted(got, key=lambda r: (r.ts is not None, r.ts or T0, r.seq)):
                assert r.executed == (want[r.symbol, r.seq] != last[r.symbol])
                last[r.symbol] = want[r.symbol, r.seq]
        results.append(sorted([(r.symbol, r.seq, r.position, r.trade_size, r.total_cost) for r in got], key=str))
    assert results[0] == results[1]


def test_small_moves_without_a_dead_band_are_an_error(spark):
    df = spark.createDataFrame([("a", T0, 1, 1, 1.0, 5.0), ("a", T0, 2, 1, 1.05, 5.0)], SCHEMA)
    with pytest.raises(Exception, match="dead_band"):
        ledger.execute_trades(df, ExecutionConfig(), KEYED).collect()
    assert [r.position for r in ledger.execute_trades(
        df, ExecutionConfig(mode="mtm", execution_delay=0, dead_band=True), KEYED).orderBy("seq").collect()] == [1.0, 1.0]
    with pytest.raises(ValueError):
        ExecutionConfig(dead_band=True, min_trade_size=0.0)
    none = df.limit(0)
    assert ledger.execute_trades(none, ExecutionConfig(dead_band=True), CHUNKED).count() == 0


# ------------------------------------------------------------------ sliding frames

@pytest.mark.parametrize("n", [1, 2, 7, 30, 200])
def test_sliding_frames_match_plain_frames(spark, n):
    rng = random.Random(n)
    rows = [(r[0], r[1], r[2], None if rng.random() < 0.02 else 1e7 + rng.gauss(0, 1), rng.gauss(0, 5))
            for r in series(rng, 150)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, seq long, pnl double, total double")
    for o in (KEYED, replace(CHUNKED, chunk_rows=200)):
        got = sliding_frames(df, o, n, "pnl", "total", "s", "d", "x").collect()
        assert len(got) == len(rows)
        for s in ("a", "b", None):
            mine = sorted((r for r in got if r.symbol == s), key=lambda r: (r.ts is not None, r.ts or T0, r.seq))
            for i, r in enumerate(mine):
                part = mine[max(0, i - n + 1):i + 1]
                v = [q.pnl for q in part if q.pnl is not None]
                if len(v) < n:
                    assert r.s is None and r.d is None
                else:
                    mean = math.fsum(v) / n
                    assert r.s == pytest.approx(math.fsum(v), rel=1e-12)
                    if n > 1:
                        assert r.d == pytest.approx(math.sqrt(math.fsum((q - mean) ** 2 for q in v) / (n - 1)), rel=1e-6)
                assert r.x == (max(q.total for q in part) if len(part) == n else None)


# ------------------------------------------------------------------ even cells

def burst(rng):
    """80 % of the rows of one symbol in one hour, a third of them in one instant."""
    rows, hour = [], datetime(2024, 1, 2, 5)
    for i in range(3000):
        if i < 1000:
            t = hour
        elif i < 2400:
            t = hour + timedelta(seconds=rng.randrange(3600))
        else:
            t = T0 + timedelta(minutes=rng.randrange(5000))
        rows.append(("a", t, i, rng.choice([-1, 0, 1]), 1.0, 100 + rng.random()))
    rows += [("b", T0 + timedelta(minutes=i), i, 1, 1.0, 5.0) for i in range(300)]
    rows += [(None, None, i, 1, 1.0, 5.0) for i in range(900)]
    rng.shuffle(rows)
    return rows


def test_cells_of_a_burst_are_even_and_change_nothing(spark):
    df = spark.createDataFrame(burst(random.Random(2)), SCHEMA)
    plain = Ordering(chunk_rows=100)
    o = even_cells(df, plain, rows=100)
    sizes = [r["count"] for r in ordered.with_cells(df, o).groupBy(ordered.CELL).count().collect()]
    assert max(sizes) <= 200 and sum(sizes) == 4200
    assert max(r["count"] for r in ordered.with_cells(df, plain).groupBy(ordered.CELL).count().collect()) > 2000
    # per task: cells are dealt by their key, no cell holds more than twice the wanted rows
    want = sorted(map(str, ordered.with_positions(df, KEYED).collect()))
    assert sorted(map(str, ordered.with_positions(df, o).select(*df.columns, "pos").collect())) == want
    for cfg in (ExecutionConfig(), ExecutionConfig(mode="mtm"), ExecutionConfig(dead_band=True)):
        a = ledger.execute_trades(df, cfg, KEYED).collect()
        b = ledger.execute_trades(df, cfg, o).collect()
        key = lambda r: (str(r.symbol), r.seq)
        for x, y in zip(sorted(a, key=key), sorted(b, key=key)):
            assert x[:9] == y[:9] and x.cumulative_pnl == pytest.approx(y.cumulative_pnl, abs=1e-6)


def test_a_row_meets_few_cuts_however_many_cells_its_bucket_has(spark):
    hour = T0 + timedelta(hours=1)
    df = spark.createDataFrame([("a", hour + timedelta(milliseconds=i), i, 1, 1.0, 5.0) for i in range(3000)], SCHEMA)
    o = even_cells(df, Ordering(chunk_rows=100), rows=5)
    sizes = [r["count"] for r in ordered.with_cells(df, o).groupBy(ordered.CELL).count().collect()]
    assert max(sizes) <= 10 and sum(sizes) == 3000 and len(sizes) > 300
    assert max(len(r[ordered._CUTS]) for cuts in o.cuts for r in cuts.collect()) <= 128
    assert all(r.pos == r.seq for r in ordered.with_positions(df, o).collect())


def test_even_series_get_no_cuts(spark):
    df = spark.createDataFrame(series(random.Random(3), 50), SCHEMA)
    assert even_cells(df, CHUNKED, rows=1000).cuts is None
    assert even_cells(df.limit(0), CHUNKED, rows=1).cuts is None
    assert even_cells(df, KEYED, rows=1) is KEYED
    same = spark.createDataFrame([("a", T0, 1, 1, 1.0, 1.0)] * 50, SCHEMA)      # nothing tells the rows apart
    assert even_cells(same, CHUNKED, rows=5).cuts is None


# ------------------------------------------------------------------ fit, choose, report

def test_features_are_computed_once_for_a_training_frame(spark):
    from conftest import SF_SMALL
    from tickframe.plans.catalog_models import training_frame
    from tickframe.plans.catalog_training import split_rows
    data, cols = training_frame(spark, SF_SMALL, ["spread"])
    assert data.columns[-1] == "split" and "spread" in data.columns and "kurtosis_20" not in data.columns
    assert len(cols) > 80
    for df in (data, split_rows(spark, SF_SMALL)):
        read = " ".join(df.inputFiles())
        assert "events.parquet" not in read and ("training-rows" in read or "complete-rows" in read)


def test_evaluation_table_equals_the_single_tables(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        p = [rng.random() for _ in range(3)]
        rows.append((rng.choice(["m", "n"]), rng.choice([0, 2, 2, None]), rng.choice([0, 2]), *[x / sum(p) for x in p]))
    df = spark.createDataFrame(rows, "model string, label int, prediction int, prob_down double, prob_flat double, prob_up double")
    got = {(r.model, r.metric, r["class"], r.predicted): r.value for r in evaluation.evaluation_table(df, "model").collect()}
    known = df.filter("label IS NOT NULL")
    want = {}
    for r in evaluation.accuracy(known, "model").collect():
        want[r.model, "accuracy", None, None], want[r.model, "n", None, None] = r.accuracy, r.n
    for r in evaluation.confusion_matrix(known, "model").collect():
        want[r.model, "confusion", r.true_label, r.predicted] = r.n
    for r in evaluation.classification_report(known, "model").collect():
        names = {"precision": r.precision, "recall": r.recall, "f1": r.f1_score}
        if r["class"].isdigit():
            want |= {(r.model, k, int(r["class"]), None): v for k, v in (names | {"support": r.support}).items()}
        elif r["class"] != "accuracy":
            want |= {(r.model, f"{r['class'].split()[0]}_{k}", None, None): v for k, v in names.items()}
    for r in evaluation.hit_rates(known, "model").collect():
        want[r.model, "hit_rate", r["class"], None] = r.hit_rate
    for r in evaluation.confidence_stats(known, "model").collect():
        want |= {(r.model, k, None, None): r[k] for k in ("avg_confidence", "confidence_std", "avg_confidence_correct",
                                                          "avg_confidence_incorrect")}
    for r in evaluation.class_probability_stats(known, "model").collect():
        want[r.model, "avg_prob", r["class"], None], want[r.model, "std_prob", r["class"], None] = r.avg_prob, r.std_prob
    for r in evaluation.prediction_distribution(known, "model").collect():
        want[r.model, "predicted_n", r["class"], None] = r.n
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert evaluation.evaluation_table(df.limit(0), "model").count() == 0


def test_fit_choose_and_score(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        y = rng.randrange(3)
        rows.append((i, "train" if i < 360 else "val" if i < 480 else "test", y, y + rng.gauss(0, 0.3), rng.gauss(0, 1)))
    df = spark.createDataFrame(rows, "id int, split string, label int, good double, noise double")
    tries = [training.Candidate(f"{kind}_{f}", ModelConfig(kind, {"n_estimators": 5}), (f,))
             for kind in ("logistic_regression", "random_forest") for f in ("noise", "good")]
    scored, fitted = training.fit_then_score(df, tries, ("id",))
    assert scored.count() == 4 * 600 and set(fitted) == {t.name for t in tries}
    report = training.report_by_split(scored)
    choice = training.choose_model(report).collect()
    assert len(choice) == 1 and choice[0].model.endswith("_good") and choice[0].value > 0.8
    assert set(choice[0].other) == {"train", "test"} and choice[0].other["test"] > 0.8
    best = training.rows_of_choice(scored, training.choose_model(report))
    assert best.count() == 600 and best.select("model").distinct().count() == 1
    acc = report.filter("metric = 'accuracy' AND split = 'test' AND model = 'random_forest_good'").first().value
    mine = scored.filter("split = 'test' AND model = 'random_forest_good'")
    assert acc == pytest.approx(mine.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0])
    with pytest.raises(ValueError):
        training.fit_then_score(df, [tries[0], tries[0]])


def test_rolling_metrics_take_wide_windows(spark):
    n = 700
    rows = [("a", T0 + timedelta(minutes=i), i, float(i % 7), float(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, seq long, pnl double, cumulative_pnl double")
    got = metrics.rolling_metrics(df, 600, o=KEYED).filter("rolling_return IS NOT NULL").collect()
    assert len(got) == n - 599 and all(r.rolling_drawdown == 0 for r in got)


def test_merged_sketches_are_near_the_exact_quantiles(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), d, rng.lognormvariate(0, 2)) for d in range(20) for _ in range(500)]
    rows += [("c", 0, 7.0), ("d", 0, None), ("d", 1, float("nan")), (None, 3, 1.0), (None, 4, 3.0)]
    df = spark.createDataFrame(rows, "k string, day int, v double")
    daily = quantiles.quantile_sketches(df, ["k", "day"], "v")
    got = {r.k: r for r in quantiles.merged_quantiles(daily.filter("day >= 3"), ["k"], {"lo": 0.01, "mid": 0.5, "hi": 0.99}).collect()}
    assert set(got) == {"a", "b", None} and got[None].n == 2
    for k in "ab":
        mine = sorted(v for x, d, v in rows if x == k and d >= 3)
        assert got[k].n == len(mine)
        for name, q in (("lo", 0.01), ("mid", 0.5), ("hi", 0.99)):
            rank = sum(v <= got[k][name] for v in mine) / len(mine)
            assert abs(rank - q) <= 0.01


def test_moments_keep_their_digits_beside_a_large_mean(spark):
    rng = random.Random(9)
    noise = [(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(2000)]
    rows = [(1e8 + a, 1e8 + a + b, 5.0) for a, b in noise] + [(None, 1e8, 5.0)]
    df = spark.createDataFrame(rows, "x double, y double, flat double").repartition(5)
    got = {(r.feature_a, r.feature_b): r.corr for r in metrics.feature_correlation(df, ["x", "y", "flat"]).collect()}
    xs, ys = [a for a, _ in noise], [a + b for a, b in noise]
    mx, my = sum(xs) / 2000, sum(ys) / 2000
    want = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / math.sqrt(
        sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))
    assert got["x", "y"] == pytest.approx(want, rel=1e-6) and got["x", "x"] == pytest.approx(1.0)
    assert got["x", "flat"] is None and got["flat", "flat"] is None


def test_threshold_search_skips_nan_and_keeps_digits(spark):
    rng = random.Random(10)
    rows = [(rng.random(), rng.random() / 3, 1e8 + rng.gauss(0, 1)) for _ in range(400)]
    schema = "prob_up double, prob_down double, return_forward_1 double"
    clean = signals.optimize_thresholds(spark.createDataFrame(rows, schema)).collect()
    dirty = rows + [(float("nan"), 0.0, 1e9), (0.9, float("nan"), 1e9), (0.9, 0.0, float("nan"))]
    none = [tuple(None if x != x else x for x in r) for r in dirty]
    for metric in ("sharpe", "sortino", "hit_rate"):        # NaN is read like NULL
        a, b = (signals.optimize_thresholds(spark.createDataFrame(x, schema), metric).first() for x in (dirty, none))
        assert a[:2] == b[:2] and a.score == pytest.approx(b.score, rel=1e-9)
    best = None
    for hi in signals.LONG_GRID:
        for lo in signals.SHORT_GRID:
            x = [(-1 if d > lo else 1 if u > hi else 0) * r for u, d, r in rows]
            m = math.fsum(x) / len(x)
            sd = math.sqrt(math.fsum((v - m) ** 2 for v in x) / (len(x) - 1))
            if best is None or (m / sd if sd else 0) > best:
                best = m / sd if sd else 0
    assert clean[0].score == pytest.approx(best, rel=1e-9)


# ------------------------------------------------------------------ training frames

@pytest.fixture(scope="module")
def events_dir(spark, tmp_path_factory):
    rng = random.Random(7)
    rows = [(i, T0 + timedelta(seconds=60 * i), rng.choice([0, 0, 0, 1, 9]), f'{{"k": {rng.randrange(100)}}}') for i in range(400)]
    path = str(tmp_path_factory.mktemp("events"))
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, props string").write.parquet(f"{path}/events.parquet")
    return path


def test_splits_are_laid_out_without_features(spark, events_dir, monkeypatch):
    from tickframe.operators import timeseries
    from tickframe.plans import catalog_models as cm, catalog_training as ct
    seen = []
    for name in ("time_split", "time_split_ratio"):
        def split(df, *a, _f=getattr(timeseries, name), **kw):
            seen.append(set(df.columns))
            return _f(df, *a, **kw)
        monkeypatch.setattr(timeseries, name, split)
    monkeypatch.setattr(cm.md, "fit", lambda *a, **kw: None)
    monkeypatch.setattr(cm.md, "predict", lambda model, df, *a: df)
    data, cols = cm.training_frame(spark, events_dir)
    assert set(cols) < set(data.columns) and data.count() > 50
    cm.fit_sequence(spark, events_dir)
    ct.split_rows(spark, events_dir)
    assert len(seen) == 3
    assert all(s <= {"_row", "symbol", "ts", "seq", "mid_price", "label"} for s in seen)


def test_sequence_frame_against_loop(spark, events_dir):
    from tickframe.plans import catalog_models as cm
    rows, cols = cm.complete_rows(spark, events_dir)
    found, names = cm.sequence_frame(spark, events_dir)
    assert names == cols
    got = {(r.symbol, r.seq): (r.label, r.split, list(r.seq_x)) for r in found.collect()}
    by, want = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (r.symbol, r.ts, r.seq)):
        by.setdefault(r.symbol, []).append(r)
    for symbol, s in by.items():
        kept = range(cm.SEQ_LEN, len(s) - 1)
        for k, i in enumerate(kept):
            move = (s[i + 1].mid_price - s[i].mid_price) / s[i].mid_price
            want[symbol, s[i].seq] = (2 if move > 0.001 else 0 if move < -0.001 else 1,
                                      "train" if k < math.floor(len(kept) * 0.8) else "test",
                                      [r[c] for r in s[i - cm.SEQ_LEN:i] for c in cols])
    assert len(want) > 30 and got == want


def test_vectors_are_read_a_few_rows_at_a_time(spark, events_dir, monkeypatch):
    """A reader takes thousands of rows of a row group at once, each 16 KB wide."""
    import pyarrow.parquet as pq
    from urllib.parse import urlparse
    from tickframe.plans import catalog_models as cm
    monkeypatch.setattr(cm, "WIDE_ROWS", 8)
    monkeypatch.setattr(cm, "FEW_ROWS", 30)
    found, _ = cm.sequence_frame(spark, events_dir)
    files = [pq.ParquetFile(urlparse(f).path).metadata for f in found.inputFiles()]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(groups) == found.count() > 30 and max(groups) <= 8
