"""A feed's batch is what has come since the last, however many files that is; its rows are shuffled once before they are written."""

import glob

from loomcast.plans import writing


def test_three_batches_of_any_number_of_files(spark, monkeypatch, tmp_path):
    many = spark.range(2400).selectExpr("id div 3 l_orderkey", "id l_partkey", "if(id % 2 = 0, 1, id % 40) l_suppkey", "cast(id % 3 as int) l_linenumber", "cast(id % 50 as double) l_quantity", "1D l_extendedprice", "0D l_discount", "0D l_tax", "if(id % 5 = 0, 'R', 'N') l_returnflag", "if(id % 7 = 0, 'F', 'O') l_linestatus", "timestamp'1998-01-01' + make_interval(0, 0, 0, cast(id % 100 as int)) l_shipdate")
    many.repartition(20).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", 128 << 20)  # a task a file
    monkeypatch.setattr(writing, "folder", lambda s: f"{tmp_path}/kept")
    try:
        got = {r.speaker_id: (r.n, r.total, r.units, r.last_unit) for r in writing.maintained_totals(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = {}
    for i in range(2400):
        if i % 5:
            want.setdefault(1 if i % 2 == 0 else i % 40, []).append((i % 50 + (i % 7 == 0), i // 3, (i % 100, i // 3)))
    assert got == {k: (len(v), float(sum(x[0] for x in v)), len({x[1] for x in v}), max(x[2] for x in v)[1]) for k, v in want.items()}
    assert len(glob.glob(f"{tmp_path}/kept/feed/*.parquet")) > 24
    assert sorted(p.rsplit("=", 1)[1] for p in glob.glob(f"{tmp_path}/kept/kept/manifest/state=*")) == ["0", "1", "2"]
