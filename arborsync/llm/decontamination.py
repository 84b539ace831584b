"""Benchmark decontamination: an FM-index per shard of training texts, searched for all benchmark phrases."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborsync.llm.fm_index import FmIndex
from arborsync.llm.words import ALPHANUMERIC, Words, slices, split_words
from arborsync.staging import stage

WIDTH = 10
# Benchmark text sent to the executors at once; a larger benchmark is searched block after block.
BLOCK_BYTES = 8 << 20

SPANS = "array<struct<word_begin:bigint,word_end:bigint,byte_begin:bigint,byte_end:bigint>>"
_SPAN_ARROW = pa.list_(pa.struct([(n, pa.int64()) for n in ("word_begin", "word_end", "byte_begin", "byte_end")]))


@dataclass
class Phrases:
    """Distinct phrases of one block of a benchmark, by length, and the items each stands in."""

    vocabulary: np.ndarray  # sorted word hashes; the symbol of a word is its place plus 1
    by_length: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # phrases, first owner of each, owners
    items: list[str]

    @property
    def shortest(self) -> int:
        return min(len(p[0][0]) for p in self.by_length)

    @classmethod
    def of(cls, rows: list[tuple[str, bytes | None]], width: int) -> Phrases | None:
        words = split_words([text for _, text in rows], ALPHANUMERIC, lower=True)
        if not len(words.hashes):
            return None
        vocabulary = np.unique(words.hashes)
        symbols = np.searchsorted(vocabulary, words.hashes) + 1
        found: dict[int, list[np.ndarray]] = {}
        for item in range(len(rows)):
            own = symbols[words.bounds[item] : words.bounds[item + 1]]
            if len(own):
                cut = min(width, len(own))
                views = np.lib.stride_tricks.sliding_window_view(own, cut)
                found.setdefault(cut, []).append(np.column_stack((views, np.full(len(views), item))))
        by_length = []
        for parts in found.values():
            table = np.unique(np.concatenate(parts), axis=0)
            phrases, first = np.unique(table[:, :-1], axis=0, return_index=True)
            by_length.append((phrases, np.append(first, len(table)), table[:, -1]))
        return cls(vocabulary, by_length, [name for name, _ in rows])


def occurrences(words: Words, phrases: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(word index, phrase number, table number) of all places of all phrases in the texts of ``words``.

    Symbols of the index are the benchmark's words. Every other word and the end of a text closes a
    run; a run shorter than the shortest phrase holds none and is left out.
    """
    slot = np.minimum(np.searchsorted(phrases.vocabulary, words.hashes), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[slot] == words.hashes
    opens = known.copy()
    opens[1:] &= ~known[:-1]
    text_starts = words.bounds[:-1][words.bounds[:-1] < len(known)]
    opens[text_starts] = known[text_starts]
    member = np.flatnonzero(known)
    run = np.cumsum(opens)[member] - 1
    long_enough = np.bincount(run) >= phrases.shortest if len(run) else np.zeros(0, dtype=bool)
    chosen = long_enough[run]
    member = member[chosen]
    if not len(member):
        return
    run = (np.cumsum(long_enough) - 1)[run[chosen]]
    place = np.arange(len(member)) + run
    symbols = np.zeros(len(member) + int(run[-1]) + 1, dtype=np.int64)
    symbols[place] = slot[member] + 1
    origin = np.zeros(len(symbols), dtype=np.int64)
    origin[place] = member
    index = FmIndex(symbols, len(phrases.vocabulary))
    for number, (table, _, _) in enumerate(phrases.by_length):
        low, high = index.search(table)
        size = np.maximum(high - low, 0)
        phrase = np.repeat(np.arange(len(table)), size)
        rows = np.arange(len(phrase)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        yield origin[index.locate(rows)], phrase, number


def _search(texts: list[bytes | None], phrases: Phrases) -> tuple[Words, list[list[dict]], list[list[str]]]:
    """Words of the texts, and per text the merged spans of hit words and the items that hit it."""
    words = split_words(texts, ALPHANUMERIC, lower=True)
    edge = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    owners: list[np.ndarray] = []
    for at, phrase, number in occurrences(words, phrases):
        table, first, items = phrases.by_length[number]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + table.shape[1], -1)
        text = np.searchsorted(words.bounds, at, side="right") - 1
        # Owners once per text and phrase, however often it occurs there.
        once = np.unique(np.column_stack((text, phrase)), axis=0)
        size = first[once[:, 1] + 1] - first[once[:, 1]]
        nth = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        owner = items[np.repeat(first[once[:, 1]], size) + nth]
        owners.append(np.column_stack((np.repeat(once[:, 0], size), owner)))
    spans: list[list[dict]] = [[] for _ in texts]
    names: list[list[str]] = [[] for _ in texts]
    hit = np.cumsum(edge)[:-1] > 0
    if not hit.any():
        return words, spans, names
    opens = hit.copy()
    opens[1:] &= ~hit[:-1]
    starts = words.bounds[:-1][words.bounds[:-1] < len(hit)]
    opens[starts] = hit[starts]
    hits = np.flatnonzero(hit)
    begins = np.flatnonzero(opens)
    ends = np.append(hits[np.searchsorted(hits, begins[1:]) - 1], hits[-1])
    offsets = np.concatenate(([0], np.cumsum([len(t or b"") + 1 for t in texts])))
    for begin, end in zip(begins.tolist(), ends.tolist()):
        text = int(np.searchsorted(words.bounds, begin, side="right")) - 1
        base, offset = int(words.bounds[text]), int(offsets[text])
        spans[text].append({
            "word_begin": begin - base, "word_end": end + 1 - base,
            "byte_begin": int(words.starts[begin]) - offset,
            "byte_end": int(words.starts[end] + words.lengths[end]) - offset,
        })
    for text, item in np.unique(np.concatenate(owners), axis=0).tolist():
        names[text].append(phrases.items[item])
    return words, spans, names


def merge_spans(one: list[dict], two: list[dict]) -> list[dict]:
    """Union of two lists of spans; spans that touch become one."""
    out: list[dict] = []
    for span in sorted([*one, *two], key=lambda s: s["word_begin"]):
        if out and span["word_begin"] <= out[-1]["word_end"]:
            if span["word_end"] > out[-1]["word_end"]:
                out[-1] = out[-1] | {"word_end": span["word_end"], "byte_end": span["byte_end"]}
        else:
            out.append(dict(span))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, width: int) -> Iterator[Phrases]:
    """The phrases of a benchmark, block by block; a block is bounded on its way to the driver."""
    rows = benchmark.select(
        F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("name"), F.col(f"`{text}`").cast("binary").alias("text")
    ).where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(math.ceil(size / BLOCK_BYTES), 1)
    for block in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block).distinct()
        phrases = Phrases.of([(r["name"], bytes(r["text"])) for r in own.collect()], width)
        if phrases is not None:
            yield phrases


def find(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", phrase: str = "text", width: int = WIDTH
) -> DataFrame:
    """Add n_words, spans (merged runs of hit words, in words and bytes) and items (ids that hit the text).

    A phrase is ``width`` consecutive words of an item, or all words of a shorter one. Null and empty
    texts have no words; null or wordless items have no phrase; a null id counts as the empty string.
    Input columns of the added names are replaced.
    """
    added = ("n_words", "spans", "items")
    plain = docs.drop(*added)
    start = plain.withColumns({
        "n_words": F.lit(0).cast("bigint"), "spans": F.array().cast(SPANS), "items": F.array().cast("array<string>"),
        "_bytes": F.col(f"`{text}`").cast("binary"),
    })
    out = start
    number = 0
    for number, phrases in enumerate(_blocks(benchmark, item, phrase, width), 1):
        # Blocks after the first work on written rows, so that a task searches one block at a time.
        source = out if number == 1 else stage(out, "decontaminate")
        out = source.mapInArrow(_searcher(docs.sparkSession.sparkContext.broadcast(phrases)), start.schema)
    if not number:
        empty = Phrases(np.zeros(1, dtype=np.uint64), [], [])
        out = start.mapInArrow(_searcher(docs.sparkSession.sparkContext.broadcast(empty)), start.schema)
    return out.drop("_bytes")


def _searcher(shipped):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shipped.value
        for batch in batches:
            place = {name: batch.schema.get_field_index(name) for name in ("n_words", "spans", "items")}
            for begin, texts in slices(batch, "_bytes"):
                part = batch.slice(begin, len(texts))
                if phrases.by_length:
                    words, spans, names = _search(texts, phrases)
                else:
                    words = split_words(texts, ALPHANUMERIC, lower=True)
                    spans, names = [[] for _ in texts], [[] for _ in texts]
                held, known = part.column(place["spans"]), part.column(place["items"])
                for row in range(len(texts)):
                    if len(held[row]):
                        spans[row] = merge_spans(held[row].as_py(), spans[row])
                    if len(known[row]):
                        names[row] = sorted({*known[row].as_py(), *names[row]})
                columns = list(part.columns)
                columns[place["n_words"]] = pa.array(np.diff(words.bounds), pa.int64())
                columns[place["spans"]] = pa.array(spans, _SPAN_ARROW)
                columns[place["items"]] = pa.array([sorted(set(n)) for n in names], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return search


def cut(text: Column, spans: Column) -> Column:
    """``text`` without the bytes of ``spans``, which lie in order and apart; whole words, so what is left is text too."""
    raw = text.cast("binary")
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["byte_end"].cast("bigint")))
    ends = F.concat(F.transform(spans, lambda s: s["byte_begin"].cast("bigint")), F.array(F.octet_length(raw).cast("bigint")))
    pieces = F.zip_with(begins, ends, lambda b, e: F.substring(raw, (b + 1).cast("int"), (e - b).cast("int")).cast("string"))
    return F.array_join(pieces, "")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit spans cut out of their texts. A text that had hits and keeps no word goes.

    Rows without a hit, null and empty texts among them, stay as they are. Words around a cut
    become neighbours; they are not searched again.
    """

    others = [c for c in docs.columns if c != text]
    row = F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_none")).alias("_row")
    found = find(docs.select(row, F.col(f"`{text}`").alias("_text")), benchmark, text="_text", **options)
    hit = F.size("spans") > 0
    words_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["word_end"] - s["word_begin"])
    kept = found.where(~hit | (words_hit < F.col("n_words")))
    cleaned = F.when(hit, cut(F.col("_text"), F.col("spans"))).otherwise(F.col("_text"))
    named = kept.withColumn("_text", cleaned)
    return named.select(*[F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`") for c in docs.columns])
