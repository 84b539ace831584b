import hashlib
import math
import random

from arborsync.operators import diff, renames


def text(rng, n=60):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def edited(rng, base, changes):
    words = base.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(5000)}"
    return " ".join(words)


def grams(value):
    words = value.split()
    return {tuple(words[i : i + 3]) for i in range(max(len(words) - 2, 1))}


def similarity(a, b):
    return len(grams(a) & grams(b)) / max(len(grams(a)), len(grams(b)))


def run(spark, old, new):
    tree = "repo_id string, path string, blob_sha string, mode string"
    make = spark.createDataFrame
    sides = [make([("r", p, f"s{hash(t)}", "100644") for p, t in files.items()], tree) for files in (old, new)]
    texts = {t for files in (old, new) for t in files.values()}
    blobs = make([(f"s{hash(t)}", bytearray(t.encode()), None) for t in texts], "blob_sha string, content binary, read_error string")
    changes = diff.changeset(*sides)
    return changes, renames.similar_renames(changes, blobs)


def test_near_copies_pair_and_strangers_do_not(spark):
    rng = random.Random(5)
    bases = [text(rng) for _ in range(25)]
    old = {f"old/{i:02d}": b for i, b in enumerate(bases)}
    new = {f"new/{i:02d}": edited(rng, b, 4) for i, b in enumerate(bases)}
    old |= {f"gone/{i}": text(rng) for i in range(5)}
    new |= {f"fresh/{i}": text(rng) for i in range(5)}
    changes, found = run(spark, old, new)
    pairs = {r["old_path"]: (r["new_path"], r["similarity"]) for r in found.collect()}
    # Brute force: exactly the pairs over the threshold, each with its exact score.
    expected = {
        a: (b, similarity(x, y)) for a, x in old.items() for b, y in new.items() if similarity(x, y) >= 0.5
    }
    assert pairs == expected and len(pairs) > 15
    merged = renames.merge_similar(changes, found).collect()
    assert sum(r["status"] == "R" for r in merged) == len(pairs)
    assert len(merged) == len(old) + len(new) - len(pairs)


def test_one_big_bucket_stays_one_to_one(spark):
    rng = random.Random(6)
    base = text(rng, 200)
    old = {f"old/{i:03d}": edited(rng, base, 2) for i in range(60)}
    new = {f"new/{i:03d}": edited(rng, base, 2) for i in range(40)}
    _, found = run(spark, old, new)
    rows = found.collect()
    assert len({r["old_path"] for r in rows}) == len({r["new_path"] for r in rows}) == len(rows) == 40
    for r in rows:
        assert r["similarity"] == similarity(old[r["old_path"]], new[r["new_path"]]) >= 0.5


def test_a_shared_header_loses_no_pair(spark):
    rng = random.Random(7)
    header = text(rng, 40)
    bases = [header + " " + text(rng, 60) for _ in range(150)]
    old = {f"old/{i:03d}": b for i, b in enumerate(bases)}
    new = {f"new/{i:03d}": edited(rng, b, 3) for i, b in enumerate(bases)}
    _, found = run(spark, old, new)
    assert sorted((r["old_path"][4:], r["new_path"][4:]) for r in found.collect()) == [(f"{i:03d}",) * 2 for i in range(150)]


def test_only_shared_runs_are_ordered_and_candidates_follow_the_order(spark):
    rng = random.Random(8)
    files = []
    for number in range(60):
        held = {rng.randrange(40) for _ in range(rng.randint(1, 12))} | {1000 * number + i for i in range(rng.randint(0, 8))}
        files.append((number + (number % 7 << 33), "rs"[number % 2], f"s{number}", number % 3 != 0, number % 3 != 1, sorted(held), len(held)))
    schema = "file bigint, repo_id string, blob_sha string, gone boolean, came boolean, grams array<bigint>, n int"
    table = spark.createDataFrame(files, schema)
    held_by = {}
    for f in files:
        for g in f[5]:
            held_by[f[1], g] = held_by.get((f[1], g), 0) + 1
    runs = {(g, f[1], f[0], held_by[f[1], g]) for f in files for g in f[5] if held_by[f[1], g] > 1}
    got = [tuple(r) for r in renames.shared_runs(table).select("gram", "repo_id", "file", "held_by").collect()]
    assert len(got) == len(runs) < sum(f[6] for f in files) and set(got) == runs

    for threshold in (0.3, 0.5, 0.8):
        # By definition: the first n - threshold * n + 1 runs of each file, from rare to common over all of them.
        known = {}
        for f in files:
            ordered = sorted(f[5], key=lambda g: (held_by[f[1], g], g))
            known[f[0]] = {g for g in ordered[: f[6] - math.ceil(threshold * f[6]) + 1] if held_by[f[1], g] > 1}
        expected = {
            (a[0], b[0]) for a in files for b in files
            if a[3] and b[4] and a[1] == b[1] and known[a[0]] & known[b[0]] and min(a[6], b[6]) >= threshold * max(a[6], b[6])
        }
        found = [tuple(r) for r in renames._candidates(table, threshold).collect()]
        assert len(found) == len(set(found)) and set(found) == expected
        alike = {(a[0], b[0]) for a in files for b in files if a[3] and b[4] and a[1] == b[1] and a is not b
                 and len(set(a[5]) & set(b[5])) >= threshold * max(a[6], b[6])}
        assert alike <= expected


def test_a_blob_of_two_repositories_is_paired_in_each(spark):
    rng = random.Random(9)
    first, second = text(rng), text(rng)
    edits = [edited(rng, first, 3), edited(rng, first, 5), edited(rng, second, 3)]
    held = {"a": first, "b": second, **{f"e{i}": t for i, t in enumerate(edits)}}
    change = "repo_id string, status string, old_path string, new_path string, old_blob string, new_blob string"
    changes = spark.createDataFrame([
        ("r", "D", "x", None, "a", None), ("r", "A", None, "y", None, "e0"), ("r", "A", None, "z", None, "e2"),
        ("s", "D", "x", None, "a", None), ("s", "A", None, "y", None, "e1"),
        ("t", "A", None, "x", None, "a"), ("t", "D", "y", None, "b", None), ("t", "D", "z", None, "e0", None),
    ], change)
    blobs = spark.createDataFrame([(k, bytearray(t.encode()), None) for k, t in held.items()], "blob_sha string, content binary, read_error string")
    found = {(r["repo_id"], r["old_path"], r["new_path"], r["old_blob"], r["new_blob"]): r["similarity"]
             for r in renames.similar_renames(changes, blobs).collect()}
    assert found == {
        ("r", "x", "y", "a", "e0"): similarity(first, edits[0]), ("s", "x", "y", "a", "e1"): similarity(first, edits[1]),
        ("t", "z", "x", "e0", "a"): similarity(first, edits[0]),
    }


def test_groups_in_one_pass_and_in_rounds_take_the_same_pairs(spark, monkeypatch):
    rng = random.Random(10)
    base, line = text(rng, 120), text(rng, 1200).split()
    # One group of near copies, each edited on its own, and a chain in which every file resembles the next.
    old = {f"old/{i:02d}": edited(rng, base, 4 + i) for i in range(20)}
    new = {f"new/{i:02d}": edited(rng, base, 4 + i) for i in range(20)}
    for i in range(50):
        (old, new)[i % 2][f"chain/{'on'[i % 2]}{i}"] = " ".join(line[20 * i : 20 * i + 100])
    lot = lambda a, b: hashlib.md5(f"{a}\x1f{b}".encode()).hexdigest()
    pairs = sorted((-similarity(x, y), lot(a, b), a, b) for a, x in old.items() for b, y in new.items() if similarity(x, y) >= 0.5)
    expected = {}
    for score, _, a, b in pairs:
        if a not in expected and b not in {v[0] for v in expected.values()}:
            expected[a] = (b, -score)
    changes, found = run(spark, old, new)
    staged = []
    plain = renames.stage
    monkeypatch.setattr(renames, "stage", lambda df, label: staged.append(label) or plain(df, label))
    loose = changes.select("repo_id", "status", "old_path", "new_path", "old_blob", "new_blob")
    texts = {t for files in (old, new) for t in files.values()}
    blobs = spark.createDataFrame([(f"s{hash(t)}", bytearray(t.encode()), None) for t in texts], "blob_sha string, content binary, read_error string")
    rounds = {}
    near = loose.where("not startswith(coalesce(old_path, new_path), 'chain')")
    for name, given, most in (("rounds", loose, 0), ("mixed", loose, 50_000), ("pass", near, 50_000)):
        staged.clear()
        got = renames.similar_renames(given, blobs, group_pairs=most)
        rounds[name] = staged.count("matched")
        assert {r["old_path"]: (r["new_path"], r["similarity"]) for r in got.collect()} == {
            a: b for a, b in expected.items() if given is loose or not a.startswith("chain")}
    # Near copies alone need no round beyond the pass; the chain is too long for a label to reach its ends.
    assert rounds["pass"] == 1 < rounds["mixed"] and rounds["rounds"] > 2
    assert len(found.collect()) == len(expected)


def test_copies_are_paired_without_all_their_pairs_and_no_table_goes_through_the_driver(spark, monkeypatch):
    rng = random.Random(11)
    base = text(rng, 150)
    edits = [edited(rng, base, k) for k in (3, 3, 5, 5)]
    held = {"a": base, "b": edits[0], "c": edits[1], "d": edits[2], "e": edits[3], "f": text(rng)}
    side = {"D": {"a": 60, "b": 25, "f": 9}, "A": {"c": 50, "d": 20, "e": 31}}
    rows = [("r", s, f"{s}/{b}{i}" if s == "D" else None, f"{s}/{b}{i}" if s == "A" else None, b if s == "D" else None, b if s == "A" else None)
            for s, of in side.items() for b, n in of.items() for i in range(n)]
    changes = spark.createDataFrame(rows, "repo_id string, status string, old_path string, new_path string, old_blob string, new_blob string")
    blobs = spark.createDataFrame([(k, bytearray(t.encode()), None) for k, t in held.items()], "blob_sha string, content binary, read_error string")
    lot = lambda a, b: hashlib.md5(f"{a}\x1f{b}".encode()).hexdigest()
    gone, came = [[(r[2] or r[3], r[4] or r[5]) for r in rows if r[1] == s] for s in "DA"]
    score = {(x, y): similarity(held[x], held[y]) for x in side["D"] for y in side["A"]}
    pairs = sorted((-score[x, y], lot(a, b), a, b, x, y) for a, x in gone for b, y in came if score[x, y] >= 0.5)
    expected, taken = {}, set()
    for s, _, a, b, x, y in pairs:
        if a not in expected and b not in taken:
            expected[a] = (b, x, y, -s)
            taken.add(b)
    plain, staged = renames.stage, []

    def watched(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        staged.append((label, out := plain(df, label), [line for line in plan.splitlines() if "Broadcast" in line and "Join" in line]))
        return out

    monkeypatch.setattr(renames, "stage", watched)
    monkeypatch.setattr(renames, "BLOCK_PATHS", 16, raising=False)
    for most in (50_000, 500):
        staged.clear()
        got = renames.similar_renames(changes, blobs, group_pairs=most).collect()
        assert len(got) == len(expected) == 85
        assert {r["old_path"]: (r["new_path"], r["old_blob"], r["new_blob"], r["similarity"]) for r in got} == expected
        # Rows written stay near those of the paths, not their pairs; only keys of wanted blobs may be broadcast.
        assert len(pairs) > 8000 and all(out.count() <= len(rows) for label, out, _ in staged if label != "rename-index")
        assert not [line for _, _, joins in staged for line in joins if "LeftSemi" not in line]
        assert (len([1 for label, _, _ in staged if label == "matched"]) == 1) == (most == 50_000)
