"""Similarity join on word n-grams: MinHash bands find clusters, whole n-gram sets decide every pair in them.

1. Each text gets a signature; equal texts form a class and one text stands for it.
2. Bands of the signature are shuffled; texts that share a band fall into one cluster.
3. Inside a cluster every pair of texts whose sizes allow the threshold is compared exactly, block
   against block, so that a large cluster is many bounded tasks. Pairs are counted where they are
   found and never written out; what leaves a block are counts per text and a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborsync.llm.components import connected_components
from arborsync.llm.groups import map_groups
from arborsync.llm.words import NOT_SPACE, shingles, slices, split_words
from arborsync.staging import stage

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.9999
# A block of a cluster: so many n-grams and texts at most (one text may hold more n-grams).
BLOCK_SHINGLES = 300_000
BLOCK_TEXTS = 512
# Parts of a large cluster where its texts meet what is known of it.
SALTS = 64

_NODE = "struct<id:bigint,key:binary>"


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the longest rows with which a pair at ``threshold`` meets in some band with
    probability ``recall``, using at most ``most_hashes`` hash functions."""
    fitting = []
    for rows in range(1, most_hashes + 1):
        agree = threshold**rows
        bands = 1 if agree >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-agree))
        if bands * rows <= most_hashes:
            fitting.append((rows, bands))
    if not fitting:
        raise ValueError("no banding reaches this recall with so few hashes")
    rows, bands = max(fitting)
    return bands, rows


def _constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_011).integers(0, 1 << 63, size=(2, count), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands) of n-gram sets, none of them empty."""
    factor, shift = _constants(bands * rows)
    joined = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    room = np.empty_like(joined)
    out = np.zeros((len(sets), bands), dtype=np.uint64)
    golden = np.uint64(0x9E3779B97F4A7C15)
    for number in range(bands * rows):
        np.multiply(joined, factor[number], out=room)
        room += shift[number]
        least = np.minimum.reduceat(room, starts)
        band = number // rows
        mixed = (out[:, band] ^ least) * golden
        out[:, band] = mixed ^ (mixed >> np.uint64(31))
    return out


def _sign(bands: int, rows: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in slices(batch, "_bytes"):
                words = split_words(texts, NOT_SPACE)
                sets = [shingles(words, i, width) for i in range(len(texts))]
                size = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(size)
                lists: list[np.ndarray | None] = [None] * len(texts)
                if len(full):
                    for row, own in zip(full.tolist(), signatures([sets[i] for i in full], bands, rows)):
                        lists[row] = own.view(np.int64)
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(size), pa.array(lists, pa.list_(pa.int64()))],
                    names=["doc_id", "key", "n", "bands"],
                )

    return run


def compare(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j), i < j, of sets with Jaccard similarity >= threshold, among those with
    left[i] and right[j] or the other way round."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    grams, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[place] > 1
    owner, place = owner[shared], (np.cumsum(count > 1) - 1)[place[shared]]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    columns = int((count > 1).sum())
    step = max(1, (1 << 22) // max(len(sets), 1))
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for begin in range(0, columns, step):
        low, high = np.searchsorted(place, (begin, begin + step))
        incidence = np.zeros((len(sets), min(step, columns - begin)), dtype=np.float32)
        incidence[owner[low:high], place[low:high] - begin] = 1
        common += incidence @ incidence.T
    shared_grams = np.rint(common).astype(np.int64)
    union = size[:, None] + size[None, :] - shared_grams
    # Compared in whole numbers, so that 0.8 exactly is not lost to rounding.
    scaled = round(threshold * 1_000_000)
    alike = (shared_grams * 1_000_000 >= scaled * union) & ((left[:, None] & right[None, :]) | (right[:, None] & left[None, :]))
    return np.nonzero(np.triu(alike, 1))


def _forest(count: int, one: np.ndarray, other: np.ndarray) -> list[int]:
    """Root of each of ``count`` members, given links; the root is the least member."""
    root = list(range(count))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(one.tolist(), other.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(x) for x in range(count)]


def _verify(width: int, threshold: float):
    def run(table: pa.Table) -> pa.RecordBatch | None:
        nodes = table.column("node").to_pylist()
        sides = table.column("side").to_pylist()
        chosen: dict[tuple, int] = {}
        for row, node in enumerate(nodes):  # a repeated document row is one text
            chosen.setdefault((node["key"], sides[row]), row)
        rows = sorted(chosen.values(), key=lambda r: (nodes[r]["id"] is not None, nodes[r]["id"] or 0, nodes[r]["key"]))
        texts = table.column("_bytes")
        words = split_words([texts[r].as_py() for r in rows], NOT_SPACE)
        sets = [shingles(words, i, width) for i in range(len(rows))]
        side = np.array([sides[r] for r in rows])
        # Side 0 is a block against itself; 1 and 2 are two blocks against each other.
        left, right = side <= 1, side != 1
        one, other = compare(sets, left, right, threshold)
        if not len(one):
            return None
        links = np.bincount(np.concatenate((one, other)), minlength=len(rows))
        root = _forest(len(rows), one, other)
        linked = np.flatnonzero(links).tolist()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([nodes[rows[i]] for i in linked], _node_arrow()),
                pa.array([nodes[rows[root[i]]] for i in linked], _node_arrow()),
                pa.array(links[linked], pa.int64()),
            ],
            names=["node", "root", "n_links"],
        )

    return run


def _node_arrow() -> pa.DataType:
    return pa.struct([("id", pa.int64()), ("key", pa.binary())])


def _assign(members: DataFrame) -> DataFrame:
    """(node, task, side): which block comparisons each clustered text (node, label, n) takes part in.

    A cluster that fits one block is one task. Others are cut by size, in steps wider than the
    threshold allows two similar sets to differ, and then by hash into blocks; a block meets itself,
    the other blocks of its step and those of the next step.
    """
    totals = members.groupBy("label").agg(F.sum("n").alias("grams"), F.count("*").alias("texts"))
    large = totals.where((F.col("grams") > BLOCK_SHINGLES) | (F.col("texts") > BLOCK_TEXTS))
    # A cluster may be a third of all texts: what is known of a large one is joined to its texts in so many parts.
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("part")
    salted = members.withColumn("part", F.pmod(F.xxhash64("node.key"), F.lit(SALTS)))
    marked = stage(
        salted.join(large.select("label", parts, F.lit(True).alias("large")), ["label", "part"], "left").withColumn(
            "step", F.when(F.col("large"), F.floor(F.log(F.col("n").cast("double")) / math.log(1.01 / THRESHOLD)).cast("int")).otherwise(0)),
        "cluster-steps")
    per_step = marked.where("large").groupBy("label", "step").agg(F.sum("n").alias("grams"), F.count("*").alias("texts"))
    blocks = per_step.select("label", "step", F.greatest(
        F.ceil(F.col("grams") / BLOCK_SHINGLES), F.ceil(F.col("texts") / BLOCK_TEXTS)).cast("int").alias("blocks"))
    # One entry per size step, of which there are a few dozen at most.
    by_cluster = blocks.groupBy("label").agg(F.map_from_entries(F.collect_list(F.struct("step", "blocks"))).alias("blocks"))
    placed = marked.join(by_cluster.select("label", parts, "blocks"), ["label", "part"], "left")
    count = lambda step: F.when(F.col("large"), F.coalesce(F.element_at("blocks", step), F.lit(0))).when(step == 0, 1).otherwise(0)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node.key"), count(F.col("step")).cast("bigint")).cast("int"))
    numbers = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    name = lambda s1, b1, s2, b2: F.concat_ws(
        ":", F.hex("label.key"), F.coalesce(F.col("label.id").cast("string"), F.lit("")), *[x.cast("string") for x in (s1, b1, s2, b2)])
    step, block = F.col("step"), F.col("block")
    same = F.transform(numbers(count(step)), lambda x: F.struct(
        name(step, F.least(block, x), step, F.greatest(block, x)).alias("task"),
        F.when(x == block, 0).when(block < x, 1).otherwise(2).alias("side")))
    above = F.transform(numbers(count(step + 1)), lambda x: F.struct(name(step, block, step + 1, x).alias("task"), F.lit(1).alias("side")))
    below = F.transform(numbers(count(step - 1)), lambda x: F.struct(name(step - 1, x, step, block).alias("task"), F.lit(2).alias("side")))
    return placed.select("node", F.inline(F.concat(same, above, below)))


def similar_texts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_copies, key, head.

    Words are runs of anything but ASCII white space; a text is the set of its ``width``-word n-grams,
    a shorter one the single gram of all its words. Two different texts are linked if the Jaccard
    similarity of their sets is at least ``threshold``. class_id is the least document id among all
    texts connected by links or equality (null ids come last), n_links the number of other texts
    linked with this one, n_copies the documents with this very text, key identifies the text and
    head is true for one text of the class. A text without words (null, empty, blank) is a class of
    its own with no links; its class_id is its own id. Documents sharing an id are told apart by text.
    """
    bands, rows = choose_bands(threshold, recall)
    plain = docs.select(F.col(f"`{id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("_bytes"))
    keyed = plain.select("doc_id", F.unhex(F.md5("_bytes")).alias("key"), "_bytes")
    signed = stage(
        keyed.mapInArrow(_sign(bands, rows, width), "doc_id bigint, key binary, n bigint, bands array<bigint>"), "signatures"
    )
    classes = stage(
        signed.where("n > 0").groupBy("key").agg(
            F.min("doc_id").alias("id"), F.count("*").alias("n_copies"), F.first("n").alias("n"), F.first("bands").alias("bands")
        ).select(F.struct("id", "key").alias("node"), "n", "n_copies", "bands"),
        "classes",
    )
    met = classes.select("node", F.posexplode("bands").alias("band", "value"))
    meeting = met.groupBy("band", "value").agg(F.min("node").alias("first"), F.count("*").alias("size")).where("size > 1")
    edges = met.join(meeting, ["band", "value"]).where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    clusters = connected_components(edges)
    members = stage(clusters.join(classes.select("node", "n"), "node"), "clusters")
    tasks = stage(_assign(members), "comparisons")
    # Texts are fetched for clustered documents only, each from one document of its class.
    fetched = keyed.join(
        tasks.select("node", "task", "side", F.col("node.key").alias("key"), F.col("node.id").alias("id")), "key"
    ).where(F.col("doc_id").eqNullSafe(F.col("id"))).select("task", "side", "node", "_bytes")
    found = stage(
        map_groups(fetched, "task", _verify(width, threshold), f"node {_NODE}, root {_NODE}, n_links bigint"), "links"
    )
    links = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    joined = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = classes.select("node", "n_copies").join(links, "node", "left").join(joined, "node", "left").select(
        F.col("node.key").alias("key"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("label.id", "node.id").alias("class_id"),
        (F.coalesce("label", "node") == F.col("node")).alias("head"),
    )
    with_words = signed.where("n > 0").select("doc_id", "key").join(named, "key").select(
        "doc_id", "class_id", "n_links", "n_copies", "key", "head")
    without = signed.where("n = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"),
        F.lit(1).cast("bigint").alias("n_copies"), "key", F.lit(True).alias("head"),
    )
    return with_words.union(without)


def one_per_class(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents of ``docs`` less all but one of each class: the one with the least id stays.

    Documents without words all stay. Of rows that share both id and text one stays.
    """
    staying = similar_texts(docs, id, text, **options).where("head and doc_id <=> class_id")
    keepers = staying.groupBy("key", "doc_id").agg(F.first("n_copies").alias("_copies"))
    body = F.col(f"`{text}`").cast("binary")
    worded = F.coalesce(F.col(f"`{text}`"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    keyed = docs.withColumns({"_key": F.unhex(F.md5(body)), "_id": F.col(f"`{id}`").cast("bigint")})
    kept = keyed.where(worded).join(
        keepers.select(F.col("key").alias("_key"), F.col("doc_id").alias("_keeper"), "_copies"), "_key"
    ).where(F.col("_id").eqNullSafe(F.col("_keeper")))
    single = kept.where("_copies = 1")
    repeated = kept.where("_copies > 1").dropDuplicates(["_key"])
    chosen = [F.col(f"`{c}`") for c in docs.columns]
    return single.select(*chosen).union(repeated.select(*chosen)).union(docs.where(~worded))
