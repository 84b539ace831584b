import random

import pytest
from pyspark.sql import functions as F

from arborsync.operators import numbering, skew


def rows_with_hot_group(n=3000):
    rng = random.Random(3)
    return [("hot" if rng.random() < 0.4 else f"g{rng.randrange(20)}", f"p{i:05d}", rng.randrange(2)) for i in range(n)]


def model(rows):
    before, out = {}, {}
    for group, path, weight in sorted(rows):
        count, total = before.get(group, (0, 0))
        out[group, path] = (count + 1, total)
        before[group] = (count + 1, total + weight)
    return out


@pytest.mark.parametrize("pieces", ["1", "9"])
def test_totals_agree_with_the_model(spark, pieces):
    rows = rows_with_hot_group()
    df = spark.createDataFrame(rows, "g string, p string, w int").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", pieces)
    try:
        out = numbering.running_totals(df, ["g"], ["p"], {"n": F.lit(1), "t": F.col("w")}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {(r["g"], r["p"]): (r["n"] + 1, r["t"]) for r in out} == model(rows)
    assert len(out) == len(rows)


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, p string")
    assert numbering.number_rows(df, ["g"], ["p"], "n").collect() == []


def test_lookup_join_keeps_every_row(spark):
    rows = spark.createDataFrame(rows_with_hot_group(), "k string, p string, w int")
    table = spark.createDataFrame([("hot", 1), ("g1", 2), ("g2", 3), ("none", 4)], "k string, v int")
    assert skew.lookup_join(rows, table, ["k"]).count() == rows.count()
    assert skew.lookup_join(rows, table, ["k"], "inner").count() == rows.where("k in ('hot', 'g1', 'g2')").count()
