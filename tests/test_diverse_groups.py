"""diverse: a group that fits one task is chosen from there; the choice is that of the passes."""

import numpy as np

from loomcast.operators import search as Q


def test_one_task_chooses_what_passes_choose(spark):
    rng = np.random.default_rng(7)
    e = np.round(rng.normal(size=(300, 6)), 1)
    e /= np.maximum(np.linalg.norm(e, axis=1, keepdims=True), 1e-12)
    e[40:80] = e[:40]  # equal gains
    data = [(i, i % 3 if i % 10 else None, float(i % 4) / 4, e[i].tolist() if i % 17 else None, "t" * 50) for i in range(300)]
    data += [(300, 9, 0.5, [1.0] * 6, "x"), (301, 9, 0.5, [1.0] * 6, "y")]
    data += [(310 + i, 11, 0.5 if i else None, [1.0, None if i == 2 else float(i)], "odd") for i in range(9)]  # no plain numbers
    df = spark.createDataFrame(data, "id int, g int, s double, e array<double>, text string").repartition(3)
    for small in (True, False):
        got = [sorted(tuple(map(str, r)) for r in Q.diverse(df, "s", "e", "id", 5, keys=["g"], small_whole=small, at_once=m).collect()) for m in (1 << 14, 0)]
        assert got[0] == got[1] and len(got[0]) > 20


def test_a_small_group_takes_few_jobs(spark):
    df = spark.range(200).selectExpr("id", "0.0D as s", "array(cos(id), sin(id)) as e", "repeat('x', 100) as text")
    spark.sparkContext.setJobGroup("diverse", "")
    assert Q.diverse(df, "s", "e", "id", 15).count() == 15
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("diverse"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 15
