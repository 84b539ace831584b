import random
from pathlib import Path

import pytest

from arborsync.sources import ranged

SCHEMA = "source_url string, content string, sync_id bigint"


def table(spark, rows):
    return spark.createDataFrame([(k, v, s) for k, (v, s) in rows.items()], SCHEMA)


def keys(spark, names):
    return spark.createDataFrame([(k,) for k in names], "source_url string")


def held(spark, path):
    rows = ranged.read_ranged(spark, path, spark.createDataFrame([], SCHEMA).schema).collect()
    assert len({r["source_url"] for r in rows}) == len(rows)
    return {r["source_url"]: (r["content"], r["sync_id"]) for r in rows}


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("data/**/part-*.parquet")}


def test_only_touched_ranges_are_written(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = {f"u{i}": (f"text {i}", 1) for i in range(3000)}
    ranged.upsert_ranged(path, table(spark, rows), None, 1, range_rows=40)
    assert held(spark, path) == rows
    first = files(path)
    assert len(first) > 100
    change = {"u7": ("new", 2), "u8": ("newer", 2), "fresh": ("x", 2)}
    for _ in range(2):  # a repeated version replaces itself
        ranged.upsert_ranged(path, table(spark, change), keys(spark, ["u9", "nowhere"]), 2, range_rows=40)
        want = {**rows, **change}
        want.pop("u9")
        assert held(spark, path) == want
        second = files(path)
        assert first <= second and len(second - first) <= 5
    named = ranged._manifest(spark, path)
    assert sum(n for _, n in named.values()) == 3000
    assert sum(v == 1 for v, _ in named.values()) >= len(named) - 5


@pytest.mark.parametrize("seed", [1, 2])
def test_random_versions(spark, tmp_path, seed):
    rng, path, model = random.Random(seed), str(tmp_path / "docs"), {}
    for version in range(1, 7):
        change = {f"k{rng.randrange(400)}": (f"{version}", version) for _ in range(rng.choice([5, 120]))}
        gone = [f"k{rng.randrange(400)}" for _ in range(60)] if version != 3 else [f"k{i}" for i in range(400)]
        ranged.upsert_ranged(path, table(spark, change), keys(spark, gone) if version % 2 else None, version, range_rows=30)
        model = {k: v for k, v in model.items() if k not in gone or not version % 2} | change
        assert held(spark, path) == model
        named = ranged._manifest(spark, path)
        assert not any(a != b and b.startswith(a) for a in named for b in named)
    # A version without its manifest is not seen.
    before = held(spark, path)
    (Path(path) / "manifest/version=6/_SUCCESS").unlink()
    assert held(spark, path) != before or model == before


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "docs")
    assert held(spark, path) == {}
    ranged.upsert_ranged(path, table(spark, {}), keys(spark, ["x"]), 1)
    assert held(spark, path) == {}
