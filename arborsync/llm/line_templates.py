"""Line deduplication by a tree of log templates.

A line is its white-space separated tokens, in which numbers are variable fields; a line of mostly
numbers has no fields and stands for itself. The tree has a fixed depth: the number of tokens, then
the leading tokens one by one. In a leaf, lines that agree in most segments of their remaining tokens
share a template. Templates that recur across different
texts are dropped everywhere but in the first text that has them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborsync.llm.components import connected_components
from arborsync.llm.words import NOT_SPACE, byte_class, hash_runs, mix, split_words
from arborsync.staging import stage

LEADING = 3
SEGMENTS = 8
AGREE = 0.75
# Different texts that must hold a template for it to be dropped.
LEAST_TEXTS = 2
# Lines of fewer tokens, unless they hold so many bytes (scripts without white space), recur by
# chance sooner and need more different texts.
LONG_TOKENS = 4
LONG_BYTES = 30
SHORT_TEXTS = 5

# Numbers of a line are fields only if so many of its tokens are words without a digit.
FIXED = 0.5

# Lines are parsed about so many bytes at a time, whichever texts they are from. Parsing takes up to
# 70 bytes for one of them; only a single longer line is parsed in one go.
PARSE_BYTES = 512 << 10

_PLACE = np.uint64(0x9E3779B97F4A7C15)
_OCCURRENCE = "doc_id bigint, key binary, line_no int, line binary, short boolean, leaf bigint, segments array<int>"


# Bytes of letters, digits and all characters beyond ASCII; of these the letters; digits of base 16.
_WORD = byte_class(bytes(b for b in range(0x80) if not chr(b).isalnum()))
_LETTER = byte_class(bytes(b for b in range(0x80) if not chr(b).isalpha()))
_HEX = np.isin(np.arange(256), list(b"0123456789abcdefABCDEF"))


def _masked(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, length) of tokens with their numbers masked: runs of digits, with ``.`` or ``,`` between
    digits, and whole runs of letters and digits that read as a number of base 16. What is around them stays."""
    ends = np.cumsum(lengths + 1)
    begins = ends - lengths - 1
    # Each token and the separator behind it, one after the other.
    data = raw[np.repeat((starts - begins).astype(np.int32), lengths + 1) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
    digit = (data >= 48) & (data <= 57)
    edges = np.flatnonzero(np.diff(_WORD[data].view(np.int8), prepend=0, append=0))
    low, high = edges[0::2], edges[1::2]
    held = lambda marks: (lambda total: total[high] - total[low])(np.concatenate(([0], np.cumsum(marks, dtype=np.int32))))
    whole = (held(_HEX[data]) == high - low) & (held(digit) > 0)
    step = np.zeros(len(data) + 1, dtype=np.int8)
    step[low[whole]], step[high[whole]] = 1, -1
    field = digit | (np.cumsum(step[:-1], dtype=np.int8) > 0)
    point = np.zeros(len(data), dtype=bool)
    point[1:-1] = ((data[1:-1] == 46) | (data[1:-1] == 44)) & digit[:-2] & digit[2:]
    field |= point
    stays = ~field
    stays[:1] |= field[:1]
    stays[1:] |= field[1:] & ~field[:-1]
    at = np.concatenate(([0], np.cumsum(stays, dtype=np.int32)))
    text = np.concatenate((np.where(field, np.uint8(48), data)[stays], np.zeros(8, np.uint8)))
    size = at[begins + lengths] - at[begins]
    return hash_runs(text, at[begins], size), size


def parse_lines(texts: list[bytes | None], leading: int = LEADING, segments: int = SEGMENTS, least: int = LONG_TOKENS) -> dict:
    """Columns (text, line_no, line, short, leaf, segments as offsets and values) of all lines of at least ``least`` tokens.

    ``line`` identifies the line with its variable fields masked, ``leaf`` its place in the tree.
    A line in which less than ``FIXED`` of the tokens hold a letter and no digit keeps its numbers and
    has no segments: it is like no other line.
    A line of no more than ``leading`` tokens has no segments and a leaf of its own.
    """
    words = split_words(texts, NOT_SPACE)
    raw = np.frombuffer(words.data, dtype=np.uint8)
    ends = np.flatnonzero(raw == 10)
    line = np.searchsorted(ends, words.starts).astype(np.int32)
    holds = lambda marks: (
        lambda total: total[words.starts + words.lengths] > total[words.starts])(np.concatenate(([0], np.cumsum(marks, dtype=np.int32))))
    numeric = holds((raw >= 48) & (raw <= 57))
    first = np.flatnonzero(np.diff(line, prepend=-1))
    count = np.diff(np.append(first, len(line)))
    keep = np.flatnonzero(count >= least)
    if not len(keep):
        nothing = np.zeros(0, dtype=np.int64)
        return {"text": nothing, "line_no": nothing, "line": b"", "short": nothing.astype(bool), "leaf": nothing, "offsets": np.zeros(1, np.int32), "values": nothing}
    chosen = np.repeat(count >= least, count)
    size = count[keep]
    start = np.cumsum(size) - size
    token, length_of, numeric = words.hashes[chosen], words.lengths[chosen], numeric[chosen]
    fixed = np.add.reduceat((holds(_LETTER[raw])[chosen] & ~numeric).astype(np.int64), start) >= FIXED * size
    fields = np.flatnonzero(numeric & np.repeat(fixed, size))
    token[fields], length_of[fields] = _masked(raw, words.starts[chosen][fields], length_of[fields])
    place = np.arange(len(token)) - np.repeat(start, size)
    salt = place.astype(np.uint64) * _PLACE
    length = mix(size.astype(np.uint64))
    one = np.add.reduceat(mix(token + salt), start) ^ length
    two = np.add.reduceat(mix(mix(token) ^ salt), start) + length
    early = np.where(place < leading, mix(token + ~salt), np.uint64(0))
    leaf = mix(np.add.reduceat(early, start) ^ length)
    # Tokens after the leading ones, dealt over at most ``segments`` even segments.
    tail = np.flatnonzero((place >= leading) & np.repeat(fixed, size))
    rest, at = np.repeat(size - leading, size)[tail], place[tail] - leading
    segment = np.where(rest > segments, at * segments // np.maximum(rest, 1), at)
    row = np.repeat(np.arange(len(size)), size)[tail]
    opens = np.flatnonzero(np.diff(row * (segments + 1) + segment, prepend=-1))
    values = np.add.reduceat(mix(token[tail] + salt[tail]), opens)
    offsets = np.concatenate(([0], np.cumsum(np.where(fixed, np.clip(size - leading, 0, segments), 0)))).astype(np.int32)
    short = (size < LONG_TOKENS) & (np.add.reduceat(length_of, start) < LONG_BYTES)
    line_id = line[first[keep]]
    text_start = np.concatenate(([0], np.cumsum([len(t or b"") + 1 for t in texts])))
    text = np.searchsorted(text_start, words.starts[first[keep]], side="right") - 1
    return {
        "text": text, "line_no": line_id - np.searchsorted(ends, text_start)[text],
        "line": np.column_stack((one, two)).tobytes(), "short": short, "leaf": leaf.view(np.int64),
        "offsets": offsets, "values": (values >> np.uint64(32)).astype(np.uint32).view(np.int32),
    }


def line_slices(batch: pa.RecordBatch, column: str, limit: int = PARSE_BYTES) -> Iterator[list[tuple[int, int, bytes]]]:
    """Runs of (row, number of the first line, whole lines) of a binary ``column``, about ``limit`` bytes each.

    Longer texts are cut at line ends, the end itself left out.
    """
    values = batch.column(batch.schema.get_field_index(column))
    held, size = [], 0
    for row in range(len(values)):
        text = values[row].as_py() or b""
        begin = line = 0
        while begin <= len(text):
            end = len(text) if len(text) - begin <= limit - size else text.find(b"\n", begin + limit - size)
            end = len(text) if end < 0 else end
            piece = text[begin:end]
            held.append((row, line, piece))
            size += len(piece) + 1
            if size >= limit:
                yield held
                held, size = [], 0
            line += piece.count(b"\n") + 1
            begin = end + 1
    if held:
        yield held


def _parse(leading: int, segments: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pieces in line_slices(batch, "_bytes"):
                found = parse_lines([p for _, _, p in pieces], leading, segments, least)
                rows = len(found["text"])
                if not rows:
                    continue
                at = pa.array(np.array([r for r, _, _ in pieces])[found["text"]])
                found["line_no"] = found["line_no"] + np.array([n for _, n, _ in pieces])[found["text"]]
                bounds = pa.py_buffer((np.arange(rows + 1, dtype=np.int32) * 16).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at), batch.column(1).take(at), pa.array(found["line_no"].astype(np.int32)),
                        pa.Array.from_buffers(pa.binary(), rows, [None, bounds, pa.py_buffer(found["line"])]),
                        pa.array(found["short"]), pa.array(found["leaf"]),
                        pa.ListArray.from_arrays(pa.array(found["offsets"]), pa.array(found["values"], pa.int32())),
                    ],
                    names=["doc_id", "key", "line_no", "line", "short", "leaf", "segments"],
                )

    return run


def _keys(agree: float, segments: int, parts: bool) -> Column:
    """Hashes of sets of segments, by their count: two lines of a leaf that agree in enough of them have a hash in common.

    The sets are all that are just large enough, so that a common hash means enough agreement too.
    With ``parts`` they are as few disjoint runs as agreeing lines cannot all differ in: fewer hashes,
    and a common one means nothing yet.
    """
    chosen = F.array().cast("array<bigint>")
    for count in range(1, segments + 1):
        need = math.ceil(agree * count)
        if need == count:
            continue  # the same line
        runs = min(count - need + 1, count)
        sets = [range(i * count // runs, (i + 1) * count // runs) for i in range(runs)] if parts else combinations(range(count), need)
        hashes = [F.xxhash64(F.lit(i), *[F.get("segments", F.lit(at)) for at in held]) for i, held in enumerate(sets)]
        chosen = F.when(F.size("segments") == count, F.array(*hashes)).otherwise(chosen)
    return chosen


def _met(lines: DataFrame, keys: Column, label: str) -> DataFrame:
    """(line, first): lines that have a key in common with other lines of their leaf, and the least of these lines."""
    keyed = stage(lines.select("leaf", "line", F.explode(keys).alias("at")), label)
    shared = keyed.groupBy("leaf", "at").agg(F.min("line").alias("first"), F.max("line").alias("last")).where("first <> last")
    return keyed.join(shared.select("leaf", "at", "first"), ["leaf", "at"]).select("line", "first")


def _alike(lines: DataFrame, agree: float) -> DataFrame:
    """(a, b): links that connect all lines of a leaf which agree in enough segments, directly or by way of others."""
    rows = lines.select("leaf", "line", "segments").where(F.size(_keys(agree, SEGMENTS, True)) > 0)
    leaves = rows.groupBy("leaf").agg(F.count("*").alias("lines")).where("lines > 1").select("leaf")
    near = _met(rows.join(leaves, "leaf"), _keys(agree, SEGMENTS, True), "parts").select("line").distinct()
    links = _met(rows.join(near, "line"), _keys(agree, SEGMENTS, False), "sets")
    return links.where("line <> first").select(F.col("line").alias("a"), F.col("first").alias("b")).distinct()


def recurring_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least_texts: int = LEAST_TEXTS, agree: float = AGREE,
    short_texts: int = SHORT_TEXTS,
) -> DataFrame:
    """(key, line_numbers): for texts, known by the md5 of their bytes, the lines to drop.

    A template recurs if at least ``least_texts`` different texts hold it, a short line if
    ``short_texts`` do; copies of a text count once. The text of the least (id, key) keeps it.
    """
    plain = docs.select(
        F.col(f"`{id}`").cast("bigint").alias("doc_id"), F.unhex(F.md5(F.col(f"`{text}`").cast("binary"))).alias("key"),
        F.col(f"`{text}`").cast("binary").alias("_bytes"),
    ).where("_bytes is not null")
    seen = stage(plain.mapInArrow(_parse(LEADING, SEGMENTS, 1), _OCCURRENCE), "lines")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "key")).alias("first")
    per_text = seen.groupBy("line", "key").agg(
        F.min("doc_id").alias("doc_id"), F.min("short").alias("short"), F.first("leaf").alias("leaf"),
        F.first("segments").alias("segments"))
    lines = stage(
        per_text.groupBy("line").agg(
            F.count("*").alias("n_texts"), first, F.min("short").alias("short"), F.first("leaf").alias("leaf"),
            F.first("segments").alias("segments")),
        "distinct_lines",
    )
    template = connected_components(_alike(lines, agree)).select(
        F.col("node").alias("line"), F.col("label").alias("template"))
    merged = seen.join(template, "line").groupBy("template", "key").agg(F.min("doc_id").alias("doc_id")).groupBy("template").agg(
        F.count("*").alias("n_texts"), first)
    alone = lines.join(template, "line", "left_anti").select("line", "n_texts", "first", "short")
    # A template may be that of very many lines: two written tables can be joined in slices.
    together = template.join(stage(merged, "merged_templates"), "template").select("line", "n_texts", "first", F.lit(False).alias("short"))
    enough = F.when(F.col("short"), F.greatest(F.lit(short_texts), F.lit(least_texts))).otherwise(least_texts)
    recurring = alone.union(together).where(F.col("n_texts") >= enough).select("line", F.col("first.key").alias("keeper"))
    return seen.select("key", "line", "line_no").join(recurring, "line").where("key <> keeper").groupBy("key").agg(
        F.collect_set("line_no").alias("line_numbers"))


def drop_recurring(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with lines of recurring templates taken out of ``text``, and _lines and _dropped counts.

    Lines are what ``\\n`` separates. Null and empty texts stay as they are. Internal columns are
    removed by ``deduplicate_lines``.
    """
    drops = stage(recurring_lines(docs, id, text, **options), "dropped_lines")
    keyed = docs.withColumn("_key", F.unhex(F.md5(F.col(f"`{text}`").cast("binary"))))
    joined = keyed.join(drops.select(F.col("key").alias("_key"), "line_numbers"), "_key", "left")
    lines = F.split(F.col(f"`{text}`"), "\n")
    left = F.concat_ws("\n", F.filter(lines, lambda line, at: ~F.array_contains("line_numbers", at)))
    return joined.withColumns({
        "_left": F.when(F.col("line_numbers").isNull(), F.col(f"`{text}`")).otherwise(left),
        "_dropped": F.coalesce(F.size("line_numbers"), F.lit(0)),
        "_lines": F.coalesce(F.size(lines), F.lit(0)),
    })


def deduplicate_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with recurring lines dropped; a document that loses lines and keeps no word goes."""
    cleaned = drop_recurring(docs, id, text, **options)
    kept = cleaned.where((F.col("_dropped") == 0) | F.col("_left").rlike("[^\\x20\\x09-\\x0D]"))
    return kept.select(*[F.col("_left").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
