import random
from datetime import datetime, timedelta

import pytest

from arborsync.streaming import keyed

SCHEMA = "path string, ts timestamp, seq long, failed boolean, note string"
START = datetime(2024, 1, 1)


def play(spark, tmp_path, files, build, again=()):
    """Feed ``files`` of rows one micro-batch each; rows written in the end, after a restart for ``again``."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (files, again):
        for rows in part:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        if part:
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
            rows = build(stream)
            keyed.write_rows(rows, out, str(tmp_path / "checkpoint")).awaitTermination(90)
    return spark.read.schema(rows.schema).parquet(out)


def events(seed, n=120):
    rng, at, rows = random.Random(seed), START, []
    for seq in range(n):
        at += timedelta(minutes=rng.choice([0, 1, 7, 45, 200]), microseconds=rng.choice([0, 1, 999, 1000]))
        rows.append((f"p{rng.randrange(4)}", at, seq, rng.random() < 0.5, f"n{seq}"))
    return rows


def test_newest_versions_of_late_and_repeated_rows(spark, tmp_path):
    rows = events(1)
    mixed = rows + rows[::3]
    random.Random(2).shuffle(mixed)
    written = play(spark, tmp_path, [mixed[:50], mixed[50:90]], keyed.newest_versions, [mixed[90:], rows[:5]])
    assert written.columns == ["path", "ts", "seq", "failed", "note"]
    want = {r[0]: r[4] for r in rows}
    assert {r["path"]: r["note"] for r in keyed.newest_rows(written).collect()} == want
    assert written.count() <= 4 * 4  # a micro-batch tells a path once, and only what is new


def test_a_silent_path_is_forgotten(spark, tmp_path):
    rows = [(f"p{i}", START + timedelta(hours=i), i, False, "x") for i in range(30)]
    build = lambda stream: keyed.newest_versions(stream, timedelta(hours=5), "1 hour")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (rows[:15], rows[15:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = build(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source))
    query = keyed.write_rows(stream, out, str(tmp_path / "checkpoint"))
    query.awaitTermination(90)
    assert spark.read.schema(stream.schema).parquet(out).count() == 30
    removed = sum(s["numRowsRemoved"] for p in query.recentProgress for s in p["stateOperators"])
    assert removed > 0


def due(rows, first, longest, end):
    """Failures that nothing followed before they were due, and the attempt they lead to."""
    out = []
    for path in {r[0] for r in rows}:
        own, failures = sorted(r[1:4] for r in rows if r[0] == path), 0
        for i, (ts, seq, failed) in enumerate(own):
            failures = failures + 1 if failed else 0
            if failed:
                when = ts + min(first * 2 ** (failures - 1), longest)
                stop = own[i + 1][0] if i + 1 < len(own) else end
                up = lambda t: -(-(t - START) // timedelta(milliseconds=1))
                if up(when) <= (up(stop) if i + 1 < len(own) else (stop - START) // timedelta(milliseconds=1)):
                    out.append((path, failures, ts, seq, when))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_retries_fall_due_with_back_off(spark, tmp_path, seed):
    rows = events(seed)
    rng = random.Random(seed)
    cuts = sorted(rng.sample(range(1, len(rows)), 4))
    files = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    first, longest = timedelta(minutes=10), timedelta(minutes=60)
    build = lambda stream: keyed.due_retries(stream, first, longest, "5 minutes")
    got = sorted(tuple(r) for r in play(spark, tmp_path, files[:3], build, files[3:] + [rows[:7]]).collect())
    want = due(rows, first, longest, rows[-1][1] - timedelta(minutes=5))
    assert got == want and {a for _, a, *_ in want} >= {1, 2, 3}
