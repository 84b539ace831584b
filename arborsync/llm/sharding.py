"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns several points of a ring. A key starts at its own place on the ring and goes to the
next point clockwise whose shard still has room. Keys come in the order of a second hash, so the
outcome depends on keys and capacities alone. A shard fills up at one moment of that order, so the
whole assignment is described by at most one moment per shard: they are found from counts over ever
finer ranges of the order, and each key then finds its shard by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.staging import stage

POINTS = 64  # virtual nodes of a shard
CELLS = 1 << 12  # resolution of the ring
_BITS, _LEVEL = 60, 12  # the order is read in five steps of twelve bits
FOLLOWED = 10_000  # rows around the moment a shard fills up that the driver may follow one by one


def _hash(columns: Sequence[Column], salt: str) -> Column:
    """60 bits of a hash of ``columns``."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), *columns), 64 - _BITS)


@dataclass(frozen=True)
class Ring:
    """For each cell of the ring, the shards in the order in which its keys try them."""

    shards: int
    preferences: list[list[int]]

    @classmethod
    def build(cls, spark: SparkSession, shards: int, points: int = POINTS) -> Ring:
        """Points are hashes of (shard, point number), so a further shard only adds points."""
        placed = spark.range(shards).select(F.col("id").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        cell = F.pmod(_hash([F.col("shard").cast("string"), F.col("point").cast("string")], "point"), F.lit(CELLS))
        # shards x points rows, a parameter of the job.
        owners = sorted((r["cell"], r["shard"]) for r in placed.select(cell.alias("cell"), "shard").collect())
        preferences, order = [], []
        for number in range(CELLS):
            later = [shard for at, shard in owners if at >= number] + [shard for at, shard in owners if at < number]
            order = list(dict.fromkeys(later)) if not preferences or (number - 1) in {at for at, _ in owners} else order
            preferences.append(order)
        return cls(shards, preferences)

    def choice(self, full: set[int]) -> list[int]:
        """First shard with room, for each cell."""
        return [next((s for s in order if s not in full), order[0]) for order in self.preferences]


def _lookup(choices: list[int], cell: Column) -> Column:
    """Element ``cell`` of a constant list."""
    return F.element_at(F.split(F.lit(",".join(map(str, choices))), ",").cast("array<int>"), cell + 1)


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows each shard may hold. Without slack they add up to ``total`` and differ by one at most."""
    if slack:
        return [-(-int(total * (1 + slack) * 1000) // (shards * 1000)) + 1] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def _moments(keyed: DataFrame, ring: Ring, room: list[int]) -> list[tuple[tuple[int, int], int]]:
    """(place in the order, shard) at which shards fill up, in order. A place is (order, tie).

    From the last place on, counts by range of the order tell in which range the next shard fills;
    that range is counted more finely until it holds few rows, which are then followed one by one.
    """
    left, full = list(room), {s for s, r in enumerate(room) if r == 0}
    out: list[tuple[tuple[int, int], int]] = [((-1, -1), s) for s in sorted(full)]
    after = (-1, -1)
    while len(full) < ring.shards:
        goes = keyed.where((F.col("_order") > after[0]) | ((F.col("_order") == after[0]) & (F.col("_tie") > after[1])))
        goes = goes.withColumn("shard", _lookup(ring.choice(full), F.col("_cell")))
        steps = [(column, shift) for column in ("_order", "_tie") for shift in range(_BITS - _LEVEL, -1, -_LEVEL)]
        low = {"_order": 0, "_tie": 0}
        for column, shift in steps:
            counts: dict[int, dict[int, int]] = {}
            cell = F.shiftright(F.col(column) - low[column], shift).alias("cell")
            for row in goes.groupBy(cell, "shard").count().collect():  # at most 4096 cells x shards
                counts.setdefault(row["cell"], {})[row["shard"]] = row["count"]
            hit = None
            for number in sorted(counts):
                if any(n >= left[s] for s, n in counts[number].items()):
                    hit = number
                    break
                for s, n in counts[number].items():
                    left[s] -= n
            if hit is None:
                return out
            low[column] += hit << shift
            high = low[column] + (1 << shift)
            goes = goes.where((F.col(column) >= low[column]) & (F.col(column) < high))
            if sum(counts[hit].values()) <= FOLLOWED:
                break
        for row in sorted(tuple(r) for r in goes.select("_order", "_tie", "_cell").collect()):
            shard = next((s for s in ring.preferences[row[2]] if s not in full), None)
            if shard is not None:
                left[shard] -= 1
                if not left[shard]:
                    full.add(shard)
                    out.append(((row[0], row[1]), shard))
        after = (high - 1, 1 << 62) if column == "_order" else (low["_order"], high - 1)
    return out


def assign_shards(docs: DataFrame, keys: Sequence[str], shards: int, points: int = POINTS, slack: float = 0.0) -> DataFrame:
    """Add shard (0 to shards - 1) and slot (0, 1, ... within the shard, in the order of the keys).

    Without ``slack`` all shards are filled to counts at most one apart; with it a shard holds up to
    (1 + slack) of the mean, fewer keys overflow, and fewer move when a shard is added. Null keys are
    keys like others. Rows with equal keys start together and are told apart by their place in the
    written input. Input columns named shard or slot are replaced.
    """
    spark = docs.sparkSession
    plain = docs.drop("shard", "slot")
    key = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0null")) for c in keys]
    marked = stage(
        plain.withColumns({
            "_cell": F.pmod(_hash(key, "place"), F.lit(CELLS)).cast("int"),
            "_order": _hash(key, "order"), "_tie": F.monotonically_increasing_id(),
        }),
        "ring",
    )
    narrow = marked.select("_cell", "_order", "_tie")
    ring = Ring.build(spark, shards, points)
    moments = _moments(narrow, ring, capacities(narrow.count(), shards, slack))
    full: set[int] = set()
    shard = _lookup(ring.choice(full), F.col("_cell"))
    for (order, tie), filled in moments[: shards - 1]:
        full.add(filled)
        later = (F.col("_order") > order) | ((F.col("_order") == order) & (F.col("_tie") > tie))
        shard = F.when(later, _lookup(ring.choice(full), F.col("_cell"))).otherwise(shard)
    return _number(marked.withColumn("shard", shard)).drop("_cell", "_order", "_tie")


def _number(rows: DataFrame) -> DataFrame:
    """Add slot: one sort by range, then each piece is shifted by the rows of the pieces before it."""
    pieces = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["shard", "_order", "_tie"]
    ordered = rows.repartitionByRange(pieces, *by).sortWithinPartitions(*by)
    # What a row is within its piece is a fact of this one shuffle, so it is written down first.
    placed = stage(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered").withColumns({
        "_piece": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1),
    })
    # One row per piece and shard: pieces + shards rows at most.
    sizes = sorted((r["shard"], r["_piece"], r["n"]) for r in placed.groupBy("shard", "_piece").agg(F.count("*").alias("n")).collect())
    before: dict[int, int] = {}  # rows of earlier shards in the piece are not rows of this one
    shifts, total, current = [], 0, None
    for number, piece, count in sizes:
        if number != current:
            current, total = number, 0
        shifts.append((number, piece, total - before.get(piece, 0)))
        total += count
        before[piece] = before.get(piece, 0) + count
    if not shifts:
        return placed.withColumn("slot", F.lit(0).cast("bigint")).drop("_at", "_piece")
    literal = ", ".join(f"({a}, {b}L, {c}L)" for a, b, c in shifts)
    table = rows.sparkSession.sql(f"select * from values {literal} as t(shard, _piece, _shift)")
    return placed.join(F.broadcast(table), ["shard", "_piece"]).withColumn("slot", F.col("_at") + F.col("_shift")).drop(
        "_at", "_piece", "_shift")
