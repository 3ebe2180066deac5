"""How rows are dealt over tasks: by their number, not by compressed bytes or files."""

from dataclasses import replace

from pyspark.sql import Row
from pyspark.sql import functions as F

from tickframe.config import Ordering
from tickframe.operators import models as md
from tickframe.operators.ordered import apply_ordered
from tickframe.plans import catalog_features as cf

O = Ordering(chunk_rows=10, bucket="1 day")


def _series(spark, n):
    rows = [Row(symbol="AB"[i % 2] if i % 7 else None, ts=None if i % 11 == 0 else i // 3, seq=i, v=float(i % 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, ts int, seq int, v double")
    return df.withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, ts)"))


def test_chunks_are_dealt_over_the_partitions_asked_for(spark):
    def last(f, w):
        return f.withColumn("before", F.sum("v").over(w.rowsBetween(-3, 0))).withColumn("_task", F.spark_partition_id())
    df = _series(spark, 300)
    plain = apply_ordered(df, O, last, 3)
    dealt = apply_ordered(df, replace(O, partitions=9), last, 3)
    def rows(x):
        return sorted(map(repr, x.select("symbol", "ts", "seq", "before").collect()))
    assert rows(dealt) == rows(plain) and len(rows(dealt)) == 300
    assert dealt.select("_task").distinct().count() > plain.select("_task").distinct().count()


def test_partitions_of_the_features_grow_with_the_table(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(cf, "TASK_ROWS", 10)
    assert [cf.layout(spark.range(n)).partitions for n in (0, 10 * cores, 20 * cores, 40 * cores - 1)] == [
        None, None, 2 * cores, 4 * cores]


def test_small_training_sets_take_few_even_tasks(spark):
    df = spark.range(0, 1000, 1, 10).withColumn("x", F.col("id") % 3)
    few = md.fewer_tasks(df, 250)
    sizes = [r["count"] for r in few.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 10 and few.distinct().count() == 1000
    assert md.fewer_tasks(df, 50) is df
    assert md.fewer_tasks(df.filter("id < 0"), 50).count() == 0


def test_boosted_classes_that_do_not_fit_in_memory_are_grown_one_by_one(spark, monkeypatch):
    assert [md.classes_at_once(1000, 10, 3, 200_000 * n + 5) for n in (0, 1, 2, 3, 9)] == [1, 1, 2, 3, 3]
    assert md.classes_at_once(0, 10, 3, 5) == 3 and md.storage_bytes(spark) > 1 << 20
    df = spark.range(90).selectExpr("cast(id % 7 as double) x", "cast(id % 5 as double) y", "cast(id % 3 as int) label")
    seen, build = [], md.build_pipeline

    def built(*a, **kw):
        seen.append(build(*a, **kw))
        return seen[-1]
    monkeypatch.setattr(md, "build_pipeline", built)
    out = []
    for memory in (1, 1 << 40):
        monkeypatch.setattr(md, "storage_bytes", lambda spark: memory)
        model = md.fit(df, ["x", "y"], md.ModelConfig("lightgbm", {"n_estimators": 2, "max_depth": 2}))
        out.append(sorted(map(tuple, md.predict(model, df).collect())))
    assert [p.getStages()[-1].getParallelism() for p in seen] == [1, 3] and out[0] == out[1]
