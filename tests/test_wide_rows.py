"""Steps that every row of a wide table goes through."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from shoplake.operators import deltas
from shoplake.operators.measures import Stats
from shoplake.session import tune
from shoplake.streaming.replay import write_changes


def test_stages_too_large_to_be_compiled_go_without_whole_stage_code(spark):
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    assert tune(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_an_update_makes_its_old_state_of_the_row(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 10), (2, "b", None), (None, "c", 30)], "id long, name string, v long")

    def cheaper(df):
        return df.withColumn("v", F.col("v") - 1)

    seq = F.col("id") + 100
    write_changes(rows, str(tmp_path / "joined"), "u", seq, before=cheaper(rows), file="log.000007")
    write_changes(rows, str(tmp_path / "made"), "u", seq, before=cheaper, file="log.000007")
    joined, made = (sorted(r.value for r in spark.read.text(str(tmp_path / d)).collect()) for d in ("joined", "made"))
    assert joined == made and len(made) == 2
    first = json.loads(made[0])
    assert (first["before"]["v"], first["after"]["v"], first["source"]["pos"]) == (9, 10, 101)


def test_a_new_batch_is_summed_with_the_state_and_groups_join_nothing(spark):
    stats = Stats(keys=("k", "dt"), attrs=("name",), types={"m": "decimal(18,4)"}, sources={})
    keys, counters = ["k", "dt", "name"], ["n", "m"]
    ddl = "k long, dt string, name string, m long, _sign int"

    def fold(current, rows, batch, **how):
        cells = deltas.cell_deltas(spark.createDataFrame([(k, "d", s, m, i) for k, s, m, i in rows], ddl), stats)
        return deltas.folded(current, cells, keys, counters, batch, **how).cache()

    first = fold(None, [(1, "a", 5, 1), (1, "a", 2, 1), (2, "b", 1, 1), (3, "c", None, 1)], 0)
    more = [(1, "a", 5, -1), (1, "z", 4, 1), (2, "b", 1, -1)]
    second = fold(first, more, 1, repeated=False)
    assert sorted(map(tuple, second.collect())) == sorted(map(tuple, fold(first, more, 1).collect()))
    groups = deltas.groups(second, stats, 1)
    got = sorted((r.k, r.name, r.m, r._op) for r in groups.collect())
    assert got == [(1, "z", Decimal(6), "U"), (2, None, Decimal(0), "D")]
    assert "Join" not in groups._jdf.queryExecution().optimizedPlan().toString()
