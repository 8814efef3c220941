"""User aggregates called from SQL as partial and merging table functions."""

import random

from eventide.functions import udfs
from eventide.operators import aggregates


def _rows(n=3000, seed=7):
    rnd = random.Random(seed)
    keys = [None, "a", "b", "c"]
    # one key has most rows, some values and keys are null, values tie
    return [("hot" if rnd.random() < 0.6 else rnd.choice(keys), rnd.choice([None, rnd.randint(-40, 40)])) for _ in range(n)]


def _exact_avg(rows):
    out = {}
    for k in {k for k, _ in rows}:
        v = [x for key, x in rows if key == k and x is not None]
        out[k] = int(sum(v) / len(v)) if v else None
    return out


def test_average_and_top_k_of_partitions(spark, monkeypatch):
    monkeypatch.setattr(udfs, "PARTIAL_VALUES", 7)  # states are passed on and merged many times
    monkeypatch.setattr(udfs, "PARTIAL_KEYS", 2)
    rows = _rows() + [("only null", None)]
    spark.createDataFrame(rows, "k STRING, v BIGINT").repartition(6).createOrReplaceTempView("sqlagg_src")
    avg = udfs.register_aggregate(spark, udfs.AvgTemp(), "t_avg", "a BIGINT")
    got = spark.sql(avg.format(rows="SELECT k, v FROM sqlagg_src"))
    assert {r.k: r.a for r in got.collect()} == _exact_avg(rows)
    top = udfs.register_aggregate(spark, udfs.TopK(5), "t_top5", "temp DOUBLE, rank INT")
    got = {}
    for r in spark.sql(top.format(rows="SELECT k, CAST(v AS DOUBLE) AS v FROM sqlagg_src")).orderBy("rank").collect():
        got.setdefault(r.k, []).append(r.temp)
    for k in {k for k, _ in rows}:
        best = sorted((float(x) for key, x in rows if key == k and x is not None), reverse=True)[:5]
        assert got[k] == best + [aggregates.DOUBLE_MIN] * (5 - len(best))


def test_keyless_and_empty_input(spark):
    spark.range(1, 101).createOrReplaceTempView("sqlagg_ids")
    avg = udfs.register_aggregate(spark, udfs.AvgTemp(), "t_avg", "a BIGINT")
    assert [r.a for r in spark.sql(avg.format(rows="SELECT id FROM sqlagg_ids")).collect()] == [50]
    empty = spark.sql(avg.format(rows="SELECT 'x' AS k, id FROM sqlagg_ids WHERE id < 0"))
    assert empty.columns == ["k", "a"] and empty.collect() == []


def test_partials_run_before_the_shuffle(spark):
    spark.range(1, 101).createOrReplaceTempView("sqlagg_ids")
    avg = udfs.register_aggregate(spark, udfs.AvgTemp(), "t_avg", "a BIGINT")
    plan = spark.sql(avg.format(rows="SELECT id % 3 AS k, id FROM sqlagg_ids"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("t_avg(") < plan.index("Exchange hashpartitioning") < plan.index("t_avg_partial(")
    assert plan.count("Exchange") == 1
