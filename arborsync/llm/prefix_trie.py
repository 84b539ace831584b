"""The trie of conversation prefixes, from sorted conversations and the prefixes that neighbours share.

Conversations are sorted by their turns. The members of a prefix then stand in one stretch: as far to either side as
neighbours share at least so many turns. A sparse table of the minima over these shared lengths lets each prefix of
each conversation find both ends of its stretch by binary search, by itself and without a stack; the prefix is
reported by the first conversation of its stretch. All sums over a subtree are differences of running sums over the
stretch, and its least member is a range minimum too.

Three things keep this in bounded pieces. Sorted conversations lie in ranges, and a range is read in blocks; a stretch
that goes on across a block's edge is reported by every block in part, and parts, all of which add up, are summed. Each
block knows the neighbours beyond its edges, so that nothing is counted by two blocks. And conversations are cut into
segments of a few dozen turns that are sorted apart, below the fingerprint of all turns before; a long one is many rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborsync.operators.numbering import number_rows, running_totals
from arborsync.staging import stage

SEGMENT = 64
# Turns of a block at most, beside a single segment.
BLOCK_TURNS = 1 << 18

_KEY = ("segment", "k0", "k1", "k2", "k3")
_ORDER = (*_KEY, "turns", "more", "conv_id")
_ROW = (
    "piece int, part int, segment bigint, k0 bigint, k1 bigint, k2 bigint, k3 bigint, turns binary, more boolean, conv_id bigint, "
    "sizes array<bigint>, x_saved bigint, x_leaves bigint, x_children bigint"
)
_NODE = (
    "node binary, parent binary, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, ends_first bigint, ends string, open boolean"
)
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_hash(role: Column, text: Column) -> Column:
    """Hex digest of a turn; nulls are empty."""
    plain = F.coalesce(role.cast("string"), F.lit(""))
    return F.md5(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain, F.coalesce(text, F.lit(""))).cast("binary"))


def hashed_turns(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, position from 0, hash, size): the turns of each conversation in order, null turns first, ties by hash.

    Rows without a conversation are left out. From here on texts stay behind.
    """
    quoted = lambda c: F.col(f"`{c}`")
    turns = conversations.select(
        quoted(id).cast("bigint").alias("conv_id"), quoted(turn).alias("turn"), turn_hash(quoted(role), quoted(text)).alias("hash"),
        F.coalesce(F.octet_length(quoted(text)), F.lit(0)).cast("bigint").alias("size"),
    ).where("conv_id is not null")
    numbered = number_rows(turns, ["conv_id"], ["turn", "hash"], "position")
    return stage(numbered.select("conv_id", (F.col("position") - 1).alias("position"), "hash", "size"), "turns")


def rebuilt(turns: DataFrame, head: Column, source: Column, most: int) -> DataFrame:
    """``turns`` (as of ``hashed_turns``) with the first ``head`` turns of each conversation replaced by the first ``head``
    turns of the conversation ``source``, all of them if it has fewer, none if there is no such conversation.

    ``head``, which is at most ``most``, and ``source`` are expressions of conv_id.
    """
    kept = turns.where(F.col("position") >= head)
    wanted = turns.select("conv_id").distinct().select(F.col("conv_id").alias("of"), source.alias("source"), head.alias("head"))
    leading = turns.where(F.col("position") < most).select(F.col("conv_id").alias("source"), "position", "hash", "size")
    first = leading.join(wanted, "source").where(
        F.col("position") < F.col("head")).select(F.col("of").alias("conv_id"), "position", "hash", "size")
    first = stage(first, "heads")
    given = first.groupBy("conv_id").agg(F.count("*").alias("given"))
    moved = kept.join(given, "conv_id", "left").select(
        "conv_id", (F.col("position") - head + F.coalesce("given", F.lit(0))).alias("position"), "hash", "size")
    return first.unionByName(moved)


def _segments(turns: DataFrame, conversations: DataFrame, width: int) -> DataFrame:
    """One row a segment: its turns' digests one after the other, their sizes, whether the conversation goes on, and the
    fingerprint k0 to k3 of all turns before: sums of the digests of (position, turn)."""
    at = F.col("position") % width
    salted = F.md5(F.concat(F.col("position").cast("string"), F.lit(":"), F.col("hash")).cast("binary"))
    part = lambda i: F.conv(F.substring("salted", 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"s{i}")
    number = F.floor(F.col("position") / width).cast("bigint")
    whole = turns.withColumn("salted", salted).select(
        "conv_id", number.alias("segment"), F.struct(at.alias("at"), "salted", "size").alias("turn"), *[part(i) for i in range(4)],
        F.lit(False).alias("more"))
    bare = [F.lit(None).cast(whole.schema["turn"].dataType).alias("turn"), *[F.lit(0).cast("bigint").alias(f"s{i}") for i in range(4)]]
    goes_on = turns.where((at == 0) & (F.col("position") > 0)).select("conv_id", (number - 1).alias("segment"), *bare, F.lit(True).alias("more"))
    present = conversations.select("conv_id", F.lit(0).cast("bigint").alias("segment"), *bare, F.lit(False).alias("more"))
    rows = whole.unionByName(goes_on).unionByName(present).groupBy("conv_id", "segment").agg(
        F.array_sort(F.collect_list("turn")).alias("turn"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(4)], F.max("more").alias("more"))
    plain = rows.select(
        "conv_id", "segment", "more", F.unhex(F.array_join(F.col("turn.salted"), "")).alias("turns"), F.col("turn.size").alias("sizes"),
        *[f"s{i}" for i in range(4)])
    keyed = running_totals(plain, ["conv_id"], ["segment"], {f"k{i}": F.col(f"s{i}") for i in range(4)})
    return keyed.drop(*[f"s{i}" for i in range(4)])


def _sorted(rows: DataFrame) -> DataFrame:
    """``rows`` in sorted ranges, ``piece`` telling which. A range is a fact of this one shuffle, so it is written down."""
    pieces = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(rows.repartitionByRange(pieces, *_ORDER).withColumn("piece", F.spark_partition_id()), "sorted_conversations")


def _with_neighbours(pieces: DataFrame) -> DataFrame:
    """Each piece with the last row before it (part 0) and the first row behind it (part 2), in order within tasks."""
    edge = F.struct(*_ORDER)
    ends = pieces.groupBy("piece").agg(F.min(edge).alias("low"), F.max(edge).alias("high"))
    # One row a shuffle partition.
    along = Window.orderBy("piece")
    both = ends.select("piece", F.lag("high").over(along).alias("before"), F.lead("low").over(along).alias("after"))
    bare = [F.lit(None).cast("array<bigint>").alias("sizes"), *[F.lit(0).cast("bigint").alias(c) for c in ("x_saved", "x_leaves", "x_children")]]
    near = both.select("piece", F.explode(F.array(
        F.struct(F.lit(0).alias("part"), F.col("before").alias("row")), F.struct(F.lit(2).alias("part"), F.col("after").alias("row"))
    )).alias("e")).where("e.row is not null").select("piece", "e.part", "e.row.*", *bare)
    whole = pieces.withColumn("part", F.lit(1)).unionByName(near)
    columns = [f.split()[0] for f in _ROW.split(", ")]
    return whole.select(*columns).repartition("piece").sortWithinPartitions("piece", "part", *_ORDER)


@dataclass
class Block:
    """Consecutive rows of one piece as arrays. ``turns`` holds the digests of all rows, ``begin[i]:begin[i + 1]`` those of row i."""

    piece: int
    part: int
    key: np.ndarray
    more: np.ndarray
    conv: np.ndarray
    begin: np.ndarray
    turns: np.ndarray
    sizes: np.ndarray
    extra: np.ndarray

    def row(self, at: int) -> Block:
        low, high = self.begin[at], self.begin[at + 1]
        return Block(
            self.piece, self.part, self.key[at : at + 1], self.more[at : at + 1], self.conv[at : at + 1],
            np.array([0, high - low]), self.turns[low:high], self.sizes[low:high], self.extra[at : at + 1])


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[Block]:
    for batch in batches:
        column = lambda name, b=batch: b.column(b.schema.get_field_index(name))
        piece, part = column("piece").to_numpy(zero_copy_only=False), column("part").to_numpy(zero_copy_only=False)
        turns = column("turns").to_pylist()
        begin = np.concatenate(([0], np.cumsum([len(t) // 16 for t in turns]))).astype(np.int64)
        cuts = set(np.flatnonzero((np.diff(piece) != 0) | (np.diff(part) != 0)) + 1) | {len(piece)}
        key = np.column_stack([column(c).to_numpy(zero_copy_only=False) for c in _KEY])
        more, conv = column("more").to_numpy(zero_copy_only=False), column("conv_id").to_numpy(zero_copy_only=False)
        sizes = column("sizes")
        extra = np.column_stack([column(c).to_numpy(zero_copy_only=False) for c in ("x_saved", "x_leaves", "x_children")])
        low = 0
        for cut in sorted(cuts):
            while low < cut:
                high = min(max(int(np.searchsorted(begin, begin[low] + limit, side="right")) - 1, low + 1), cut)
                own = sizes.slice(low, high - low)
                yield Block(
                    int(piece[low]), int(part[low]), key[low:high], more[low:high], conv[low:high], begin[low : high + 1] - begin[low],
                    np.frombuffer(b"".join(turns[low:high]), dtype="<u8").reshape(-1, 2),
                    own.flatten().to_numpy(zero_copy_only=False).astype(np.int64), extra[low:high])
                low = high


def _with_sides(blocks: Iterator[Block]) -> Iterator[tuple[Block, Block | None, Block | None]]:
    """(block, row before, row behind) of the blocks of own rows."""
    before = block = None
    for following in blocks:
        if block is not None:
            same = following.piece == block.piece
            if block.part == 1:
                yield block, before, following.row(0) if same else None
            before = block.row(len(block.conv) - 1) if same else None
        block = following
    if block is not None and block.part == 1:
        yield block, before, None


def _shared(key_a, begin_a, turns_a, key_b, begin_b, turns_b) -> np.ndarray:
    """How many leading turns row i of one block has in common with row i of the other; -1 under different keys."""
    common = np.minimum(np.diff(begin_a), np.diff(begin_b))
    row = np.repeat(np.arange(len(common)), common)
    place = np.arange(common.sum()) - np.repeat(np.cumsum(common) - common, common)
    differs = (turns_a[begin_a[:-1][row] + place] != turns_b[begin_b[:-1][row] + place]).any(axis=1)
    out = common.copy()
    rows, first = np.unique(row[differs], return_index=True)
    out[rows] = place[differs][first]
    out[(key_a != key_b).any(axis=1)] = -1
    return out


def _lcp(block: Block, before: Block | None, after: Block | None) -> np.ndarray:
    """Turns shared with the row before, for each row and the one behind the block."""
    inner = _shared(block.key[:-1], block.begin[:-1], block.turns, block.key[1:], block.begin[1:], block.turns)
    one = lambda a, b: _shared(a.key, a.begin, a.turns, b.key, b.begin, b.turns)
    none = np.array([-1])
    first = one(before, block.row(0)) if before is not None else none
    last = one(block.row(len(block.conv) - 1), after) if after is not None else none
    return np.concatenate((first, inner, last))


def _minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: level k holds the minimum of each 2**k consecutive values."""
    levels = [values]
    width = 1
    while 2 * width <= len(values):
        held = levels[-1]
        levels.append(np.minimum(held[:-width], held[width:]))
        width *= 2
    return levels


def _range_min(levels: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low..high], both included."""
    level = np.log2(high - low + 1).astype(np.int64)
    out = np.empty(len(low), dtype=levels[0].dtype)
    for k in np.unique(level):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(levels[k][low[at]], levels[k][high[at] - (1 << k) + 1])
    return out


def stretches(lcp: np.ndarray, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row around ``row`` between which all neighbours share at least ``depth`` turns.

    ``lcp[i]`` is what rows i - 1 and i share; the stretch stays in rows 0 to len(lcp) - 2.
    """
    rows = len(lcp) - 1
    levels = _minima(lcp[1:rows]) if rows > 1 else []
    left, right = row.copy(), row.copy()
    for k in range(len(levels) - 1, -1, -1):
        step, held = 1 << k, levels[k]
        # held[i] is the minimum over the edges between rows i and i + step.
        can = right + step < rows
        can[can] = held[right[can]] >= depth[can]
        right[can] += step
        can = left - step >= 0
        can[can] = held[left[can] - step] >= depth[can]
        left[can] -= step
    return left, right


def _ids(block: Block, width: int, sums: np.ndarray, row: np.ndarray, local: np.ndarray) -> list[bytes]:
    """Depth and fingerprint of the prefixes of ``local`` turns of the segments ``row``."""
    key = block.key[row]
    depth = key[:, :1] * width + local[:, None]
    return [r.tobytes() for r in np.column_stack((depth, key[:, 1:] + sums[block.begin[row] + local] - sums[block.begin[row]]))]


def block_nodes(block: Block, before: Block | None, after: Block | None, width: int) -> pa.RecordBatch:
    """The nodes of the trie that start in ``block``, or go on in it, with what the block adds to them; segments have ``width`` turns."""
    lcp = _lcp(block, before, after)
    rows = len(block.conv)
    size = np.diff(block.begin)
    segment = block.key[:, 0]
    # Every prefix of every row, the empty one too.
    first = np.cumsum(size + 1) - size - 1
    row = np.repeat(np.arange(rows), size + 1)
    depth = np.arange(len(row)) - first[row]
    left, right = stretches(lcp, row, depth)
    reported = left == row
    named = np.cumsum(reported) - 1
    # Children: the first prefix of a row that is new belongs to the longest that is not, each further one to the one before.
    children = np.zeros(int(reported.sum()), dtype=np.int64)
    fresh = np.flatnonzero((size > lcp[:rows]) & (lcp[:rows] >= 0))
    shared = first[fresh] + lcp[fresh]
    np.add.at(children, named[first[left[shared]] + depth[shared]], 1)
    inside = reported & (depth > lcp[row]) & (depth < size[row])
    children[named[inside]] += 1

    at = np.flatnonzero(reported & ((depth > 0) | (segment[row] == 0)))
    row, depth, right, own = row[at], depth[at], right[at], named[at]
    bytes_before = np.concatenate(([0], np.cumsum(block.sizes)))
    prefix = lambda r, d: bytes_before[block.begin[r] + d] - bytes_before[block.begin[r]]
    running = lambda values: np.concatenate(([0], np.cumsum(values)))
    span = lambda sums: sums[right + 1] - sums[row]
    extra = [running(block.extra[:, i]) for i in range(3)]
    # What a row shares with the row before is saved; of that, what lies above the node is not its own.
    joins = np.maximum(lcp[:rows], 0)
    saved = running(prefix(np.arange(rows), joins))
    above = prefix(row, np.maximum(depth - 1, 0))
    goes_left = (row == 0) & (lcp[0] >= depth)
    n_saved = saved[right + 1] - saved[row + 1] - (right - row) * above + np.where(goes_left, prefix(row, joins[row]) - above, 0)
    leaf = running(~block.more & (lcp[1:] < size))
    goes_right = (right == rows - 1) & (lcp[rows] >= depth)
    is_open = goes_left | goes_right
    least = _range_min(_minima(block.conv), row, right)
    linked = (depth == width) & (span(running(block.more)) > 0)

    sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(
        np.ascontiguousarray(block.turns).view(">u4").astype(np.int64).reshape(-1, 4), axis=0)))
    node: list[bytes | None] = [None] * len(at)
    for i, name in zip(chosen := np.flatnonzero(is_open | linked), _ids(block, width, sums, row[chosen], depth[chosen])):
        node[i] = name
    # The parent of a node that is reported by row i: one turn less, reported by the first row of its own stretch.
    place = np.full(len(named), -1, dtype=np.int64)
    place[at] = np.arange(len(at))
    less = np.maximum(depth - 1, 0)
    holder = place[first[left[first[row] + less]] + less]
    inner = (depth > 1) | ((depth == 1) & (segment[row] == 0))
    known = inner & ~is_open[holder]
    parent: list[bytes | None] = [None] * len(at)
    asked = np.flatnonzero((depth > 0) & ~known & ((depth > 1) | (segment[row] > 0)))
    for i, name in zip(asked, _ids(block, width, sums, row[asked], depth[asked] - 1)):
        parent[i] = name

    sha: list[str | None] = [None if o else NOTHING for o in is_open]
    ends: list[str | None] = [None] * len(at)
    ends_first: list[int | None] = [None] * len(at)
    ended = np.concatenate((~block.more, [False]))
    for i in np.flatnonzero(ended[row] & (size[row] == depth)):
        # Members that end here come first in the stretch.
        low = high = int(row[i])
        while high <= right[i] and size[high] == depth[i] and ended[high]:
            high += 1
        text = ",".join(map(str, block.conv[low:high].tolist()))
        if is_open[i]:
            ends[i], ends_first[i] = text, int(block.conv[low])
        else:
            sha[i] = hashlib.sha256(text.encode()).hexdigest()

    whole = lambda values: pa.array(np.asarray(values, dtype=np.int64))
    total_depth = segment[row] * width + depth
    columns = {
        "node": pa.array(node, pa.binary()), "parent": pa.array(parent, pa.binary()), "depth": whole(total_depth), "conv_id": whole(least),
        "parent_conv_id": pa.array(least[holder], mask=~known, type=pa.int64()), "n_convs": whole(right - row + 1),
        "n_children": whole(children[own] + np.where(depth == width, span(extra[2]), 0)), "n_leaves": whole(span(leaf) + span(extra[1])),
        "saved_tokens": whole(n_saved + span(extra[0])), "ends_sha256": pa.array(sha, pa.string()),
        "ends_first": pa.array(ends_first, pa.int64()), "ends": pa.array(ends, pa.string()), "open": pa.array(is_open),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _nodes(limit: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, before, after in _with_sides(_blocks(batches, limit)):
            yield block_nodes(block, before, after, width)

    return run


def _joins(limit: int):
    """(conv_id, segment, saved, leaves, children): what each segment adds to the prefixes above its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, before, after in _with_sides(_blocks(batches, limit)):
            lcp = _lcp(block, before, after)
            rows, size = len(block.conv), np.diff(block.begin)
            total = np.concatenate(([0], np.cumsum(block.sizes)))
            saved = total[block.begin[:-1] + np.maximum(lcp[:rows], 0)] - total[block.begin[:-1]]
            leaves = ~block.more & (lcp[1:] < size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.conv), pa.array(block.key[:, 0]), *[pa.array(v.astype(np.int64)) for v in (saved, leaves, lcp[:rows] < 1)]],
                names=["conv_id", "segment", "saved", "leaves", "children"])

    return run


def _below(segments: DataFrame, limit: int) -> DataFrame:
    """(conv_id, segment, x_saved, x_leaves, x_children): what the later segments of a conversation add to an earlier one."""
    late = segments.where("segment > 0")
    zero = F.lit(0).cast("bigint")
    rows = late.withColumns({c: zero for c in ("x_saved", "x_leaves", "x_children")})
    added = _with_neighbours(_sorted(rows)).mapInArrow(_joins(limit), "conv_id bigint, segment bigint, saved bigint, leaves bigint, children bigint")
    added = stage(added, "later_segments")
    own = added.select("conv_id", "segment", "saved", "leaves", zero.alias("children"))
    up = added.select("conv_id", (F.col("segment") - 1).alias("segment"), zero.alias("saved"), zero.alias("leaves"), "children")
    each = own.unionByName(up).groupBy("conv_id", "segment").agg(
        F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"), F.sum("children").alias("x_children"))
    back = each.withColumn("back", -F.col("segment"))
    summed = running_totals(back, ["conv_id"], ["back"], {"x_saved": F.col("saved"), "x_leaves": F.col("leaves")})
    return summed.select("conv_id", "segment", "x_saved", "x_leaves", "x_children")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sha256) of the parts of each node, which come in order."""
    node, state = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for name, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["node", "sha"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["node", "sha"])


def prefix_trie(turns: DataFrame, conversations: DataFrame, block_turns: int = BLOCK_TURNS, segment: int = SEGMENT) -> DataFrame:
    """One row for each distinct prefix of the conversations, the empty one at the root included:

    conv_id (least member), depth, parent_conv_id (least member of the prefix of one turn less; null at the root), n_convs,
    n_children, n_leaves, saved_tokens (over the subtree, bytes of the last text times members but one) and ends_sha256
    (of the decimal ids of the members that end here, ascending, comma-joined).

    ``turns`` has conv_id, position (0, 1, ... without gaps), hash and size; ``conversations`` the conv_id of all
    conversations, those without turns too. Without any there is no root.
    """
    ids = conversations.select("conv_id").where("conv_id is not null").distinct()
    segments = stage(_segments(turns, ids, segment), "segments")
    below = _below(segments, block_turns)
    rows = segments.join(below, ["conv_id", "segment"], "left").na.fill(0, ["x_saved", "x_leaves", "x_children"])
    found = stage(_with_neighbours(_sorted(rows)).mapInArrow(_nodes(block_turns, segment), _NODE), "prefixes")

    closed = found.where("not open").drop("open", "ends", "ends_first")
    parts = found.where("open")
    summed = parts.groupBy("node", "depth").agg(
        F.first("parent", ignorenulls=True).alias("parent"), F.min("conv_id").alias("conv_id"),
        F.first("parent_conv_id", ignorenulls=True).alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    # A digest takes its bytes in order, so the ids of one node go to one task, as text of a block each.
    ends = parts.where("ends is not null").select("node", "ends_first", "ends").repartition("node").sortWithinPartitions("node", "ends_first")
    digests = ends.mapInArrow(_digests, "node binary, sha string")
    merged = summed.join(digests, "node", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(NOTHING))).drop("sha")
    whole = stage(closed.unionByName(merged), "nodes")
    holders = whole.where("node is not null").select(F.col("node").alias("parent"), F.col("conv_id").alias("held_by"))
    # All prefixes of one turn have the root as parent; its least member needs no join.
    root = whole.where("depth = 0").agg(F.min("conv_id").alias("least")).first()["least"]
    out = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    known = whole.where("parent is null").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(root).cast("bigint")).otherwise(F.col("parent_conv_id")))
    asked = whole.where("parent is not null").join(holders, "parent").withColumn("parent_conv_id", F.col("held_by"))
    return known.select(*out).unionByName(asked.select(*out))
