"""Collocations: phrases whose words stand together more often than their parts would by chance.

Frequent phrases are found as Toivonen does. A sample of the texts, read with a lowered threshold, proposes
phrases. One pass over all texts counts them and their negative border: every phrase that is not proposed
itself but whose first and last words, one left out at either end, are. A border phrase that turns out
frequent is a failure of the sample. A further pass takes every phrase that its parts, frequent or counted in
that pass themselves, make possible and that was not counted before, whatever its length: a frequent phrase
has frequent parts, so after it nothing can be missing and the search is closed.

The first full pass counts by 64-bit hashes, which keeps its shuffle small; the second counts what may be
frequent once more by the phrases themselves, so a collision of hashes changes no count. Proposals reach the
tasks as bits of a filter of fixed size; a bit set by another phrase makes tasks count a phrase more, never
one less.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborsync.llm.words import byte_class, mix, split_words
from arborsync.operators.numbering import number_rows
from arborsync.staging import stage

LEAST = 100
LONGEST = 5
TOP = 2000
# A phrase goes if a longer one around it has so many per cent of its occurrences.
ABSORB = 100
# One text in so many is in the sample; there a phrase must reach its share of the threshold less so many
# standard deviations. A lower threshold makes the border larger, a higher one the second pass.
SAMPLE = 8
DEVIATIONS = 1.0
# Bits of the filter that tells tasks which phrases are proposed: 16 MB, whatever the input.
FILTER_BITS = 27
# Texts are worked on so many bytes at a time, about 25 bytes of memory for each; longer ones are cut between words.
SLICE_BYTES = 2 << 20

_BUCKET_BITS = 15  # of bitmap_construct_agg
_ENDS = b".,;:!?\n\x0b\x0c\r"
_WORD = byte_class(_ENDS + b" \t")
_END = np.isin(np.arange(256), list(_ENDS))
_GAP = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_HASHED = "hash bigint, n bigint"
_NAMED = "lang string, phrase binary, n bigint"


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


class PhraseFilter:
    """Bits of proposed phrases; ``bits``, the logarithm of their number, is 15 at least."""

    def __init__(self, bits: int, held: np.ndarray | None = None) -> None:
        self.bits = bits
        self.held = np.zeros(1 << bits >> 3, dtype=np.uint8) if held is None else held

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = _places(hashes, self.bits)
        return (self.held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def __getstate__(self) -> tuple[int, bytes]:
        """A filter that is mostly empty is sent in little."""
        return self.bits, zlib.compress(self.held.tobytes(), 1)

    def __setstate__(self, state: tuple[int, bytes]) -> None:
        self.bits = state[0]
        self.held = np.frombuffer(zlib.decompress(state[1]), dtype=np.uint8)

    def joined(self, other: PhraseFilter) -> PhraseFilter:
        return PhraseFilter(self.bits, self.held | other.held)


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def cut_text(text: bytes, limit: int, longest: int) -> Iterator[tuple[bytes, int]]:
    """(piece, own): ``text`` in pieces of about ``limit`` bytes, cut between words, each followed by the
    words that phrases of its last words go on with; phrases that start in the first ``own`` bytes are its own."""
    begin = 0
    while begin < len(text) or begin == 0:
        gap = _GAP.search(text, begin + limit) if len(text) - begin > limit else None
        cut = gap.end() if gap else len(text)
        after = cut
        for _ in range(longest - 1):
            word = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]*[^ \t.,;:!?\n\x0b\x0c\r]+").match(text, after)
            if not word:
                break
            after = word.end()
        yield text[begin:after], cut - begin
        begin = cut
        if not gap:
            return


def _pieces(batches: Iterator[pa.RecordBatch], limit: int, longest: int) -> Iterator[list[tuple[str, bytes, int]]]:
    """Runs of (lang, piece, own) of about ``limit`` bytes."""
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1)
        held, size = [], 0
        for row, lang in enumerate(langs):
            for piece, own in cut_text(texts[row].as_py(), limit, longest):
                held.append((lang, piece, own))
                size += len(piece)
                if size >= limit:
                    yield held
                    held, size = [], 0
        if held:
            yield held


class Windows:
    """Phrases of up to ``longest`` words of some pieces of text, by their first word."""

    def __init__(self, pieces: list[tuple[str, bytes, int]], longest: int) -> None:
        self.langs = sorted({lang for lang, _, _ in pieces})
        code = {lang: i for i, lang in enumerate(self.langs)}
        words = split_words([p for _, p, _ in pieces], _WORD, lower=True)
        raw = np.frombuffer(words.data, dtype=np.uint8)
        count = np.diff(words.bounds)
        self.lang = np.repeat(np.array([code[lang] for lang, _, _ in pieces], dtype=np.int32), count)
        salts = np.array([_salt(lang) for lang in self.langs], dtype=np.uint64)
        self.words = words.hashes
        self.first = mix(words.hashes ^ salts[self.lang]) if len(count) else words.hashes
        origin = np.concatenate(([0], np.cumsum([len(p) + 1 for _, p, _ in pieces])))[:-1]
        self.own = words.starts < np.repeat(origin + np.array([own for _, _, own in pieces]), count)
        # Words left in the piece between two sentence marks, the word itself included.
        mark = np.cumsum(_END[raw], dtype=np.int32)[words.starts]
        last = np.append(np.flatnonzero(np.diff(mark)), len(mark) - 1) + 1 if len(mark) else np.zeros(0, np.int64)
        self.left = np.repeat(last, np.diff(np.concatenate(([0], last)))) - np.arange(len(mark))
        # All words one after the other with one space behind each: any phrase is a stretch of it.
        stays = np.zeros(len(raw), dtype=bool)
        stays[: len(raw) - 8] = _WORD[raw[:-8]]
        ends = words.starts + words.lengths
        stays[ends] = True
        marked = raw.copy()
        marked[ends] = 32
        self.plain = marked[stays]
        self.lengths = words.lengths
        self.starts = np.cumsum(words.lengths + 1) - words.lengths - 1

    def longer(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """Hashes of phrases of ``width`` words from those of one word less; meaningless across a mark."""
        return mix(hashes[: len(self.words) - width + 1] ^ self.words[width - 1 :])

    def hashed(self, hashes: np.ndarray) -> pa.RecordBatch:
        """(hash, n) of phrases."""
        found, n = np.unique(hashes, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["hash", "n"])

    def named(self, hashes: np.ndarray, width: int, chosen: np.ndarray) -> pa.RecordBatch:
        """(lang, phrase, n) of the phrases of ``width`` words that start at the words ``chosen``."""
        _, at, n = np.unique(hashes[chosen], return_index=True, return_counts=True)
        first = chosen[at]
        begin = self.starts[first]
        size = self.starts[first + width - 1] + self.lengths[first + width - 1] - begin
        offsets = np.concatenate(([0], np.cumsum(size)))
        index = np.repeat((begin - offsets[:-1]).astype(np.int32), size) + np.arange(offsets[-1], dtype=np.int32)
        phrases = pa.Array.from_buffers(
            pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(self.plain[index].tobytes())])
        langs = pa.array(self.langs, pa.string()).take(pa.array(self.lang[first]))
        return pa.RecordBatch.from_arrays([langs, phrases, pa.array(n.astype(np.int64))], names=["lang", "phrase", "n"])

    def totals(self) -> pa.RecordBatch:
        """The number of words by language, as occurrences of the empty phrase."""
        n = np.bincount(self.lang[self.own], minlength=len(self.langs)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.langs, pa.string()), pa.array([b""] * len(n), pa.binary()), pa.array(n)], names=["lang", "phrase", "n"])


def _chained(parts: np.ndarray | None, whole: np.ndarray) -> np.ndarray:
    """Of phrases that are ``whole``, those of which both parts of one word less are ``parts``."""
    return whole if parts is None else whole & parts[: len(whole)] & parts[1 : len(whole) + 1]


def _widths(w: Windows, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, hashes, whole) of phrases by their first word; ``whole`` ones cross no mark."""
    hashes = w.first
    for width in range(1, min(longest, len(w.words)) + 1):
        hashes = w.longer(hashes, width) if width > 1 else hashes
        yield width, hashes, w.left[: len(hashes)] >= width


def _count(widths: range, longest: int, limit: int, proposed=None):
    """Counts by hash of the phrases of ``widths`` words of which both parts of one word less are proposed.

    ``proposed``: a broadcast filter and the greatest width it knows; beyond, and without a filter, what is
    counted stands for what is proposed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = proposed.value if proposed is not None else (None, 0)
        for pieces in _pieces(batches, limit, longest):
            w, parts = Windows(pieces, longest), None
            for width, hashes, whole in _widths(w, widths.stop - 1):
                counted = _chained(parts, whole)
                if width in widths:
                    yield w.hashed(hashes[counted & w.own[: len(hashes)]])
                parts = counted & held.holds(hashes) if width <= known else counted

    return run


def _resolve(longest: int, limit: int, proposed, frequent):
    """Counts by name of the phrases that the pass with ``proposed`` found ``frequent`` (broadcast filters), and of
    those it did not count although both their parts are frequent or counted here; and all words as the empty phrase.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (before, _), (found, _) = proposed.value, frequent.value
        for pieces in _pieces(batches, limit, longest):
            w, parts, old = Windows(pieces, longest), None, None
            yield w.totals()
            for width, hashes, whole in _widths(w, longest):
                counted = _chained(old, whole)
                parts = _chained(parts, whole) & (~counted | found.holds(hashes))
                old = counted & before.holds(hashes)
                chosen = np.flatnonzero(parts & w.own[: len(hashes)])
                if len(chosen):
                    yield w.named(hashes, width, chosen)

    return run


def _frequent(rows: DataFrame, run, least: int) -> DataFrame:
    return rows.mapInArrow(run, _HASHED).groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("hash")


def _filter_of(frequent: DataFrame, bits: int) -> PhraseFilter:
    """The filter of the phrases in ``frequent``. Bits are set where the phrases are; only the filter, of fixed
    size, comes to the driver."""
    place = F.shiftrightunsigned("hash", 64 - bits)
    parts = frequent.select(place.alias("place")).groupBy(F.shiftright("place", _BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND((1 << _BUCKET_BITS) - 1)).alias("bits"))
    held = np.zeros(1 << bits >> 3, dtype=np.uint8)
    for part in parts.collect():
        begin = part["bucket"] << _BUCKET_BITS >> 3
        held[begin : begin + len(part["bits"])] = np.frombuffer(bytes(part["bits"]), dtype=np.uint8)
    return PhraseFilter(bits, held)


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", id: str | None = None, least: int = LEAST, longest: int = LONGEST,
    sample: int = SAMPLE, bits: int = FILTER_BITS, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(lang, phrase, f): phrases of 1 to ``longest`` words with at least ``least`` occurrences in a language, exact;
    the empty phrase stands for all words of the language.

    A null ``lang`` is ``und``; null texts hold nothing. Repeated rows count each time. Memory follows
    ``slice_bytes`` and the longest word, not the longest text.
    """
    quoted = lambda c: F.col(f"`{c}`")
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(quoted(lang).cast("string"), F.lit("und")).alias("lang"), quoted(text).cast("binary").alias("bytes"),
        F.xxhash64(quoted(text), *([quoted(id)] if id else [])).alias("draw"),
    ).where("bytes is not null")
    plain = rows.select("lang", "bytes")
    drawn = rows.where(F.pmod("draw", F.lit(sample)) == 0).select("lang", "bytes")
    share = least / sample
    lowered = max(2, math.floor(share - DEVIATIONS * math.sqrt(share)))
    send = lambda held, known=longest: spark.sparkContext.broadcast((held, known))

    # The sample: words and pairs, then longer phrases made of frequent pairs.
    pairs = stage(_frequent(drawn, _count(range(1, min(2, longest) + 1), longest, slice_bytes), lowered), "sample_pairs")
    held = _filter_of(pairs, bits)
    if longest > 2:
        of_pairs = send(held, 2)
        more = stage(_frequent(drawn, _count(range(3, longest + 1), longest, slice_bytes, of_pairs), lowered), "sample_longer")
        of_pairs.destroy()  # what it helped to count is written
        held = held.joined(_filter_of(more, bits))

    proposed = send(held)
    seen = stage(_frequent(plain, _count(range(1, longest + 1), longest, slice_bytes, proposed), least), "frequent_hashes")
    found = send(_filter_of(seen, bits))
    counts = plain.mapInArrow(_resolve(longest, slice_bytes, proposed, found), _NAMED).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    whole = stage(counts.where((F.col("f") >= least) | (F.octet_length("phrase") == 0)), "phrases")
    proposed.destroy()
    found.destroy()
    return whole.select("lang", F.col("phrase").cast("string").alias("phrase"), "f")


def score_phrases(frequent: DataFrame, absorb: int = ABSORB) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all phrases of two words and more that no longer one absorbs.

    Of all cuts in two parts the one with the lowest score counts, the earliest among equals.
    """
    counts = stage(frequent.withColumn("words", F.split("phrase", " ")), "counts")
    totals = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    words = counts.where("phrase <> ''")
    long = words.where(F.size("words") > 1)
    part = words.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    cuts = long.select(
        "lang", "phrase", F.col("f").alias("a"), "words",
        F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("words", F.lit(1), F.col("k"))).alias("front"),
        F.concat_ws(" ", F.slice("words", F.col("k") + 1, F.size("words"))).alias("back"),
    )
    met = cuts.join(part.select("lang", F.col("part").alias("front"), F.col("part_f").alias("l")), ["lang", "front"])
    met = met.join(part.select("lang", F.col("part").alias("back"), F.col("part_f").alias("r")), ["lang", "back"])
    met = met.join(totals, "lang")
    # Products may pass 64 bits; div on decimals is exact and rounds down.
    score = F.expr("(cast(a as decimal(19,0)) * 1000 * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = met.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.max("n").alias("n"), F.min("cut").alias("cut"))
    # A longer phrase has no more occurrences than any phrase inside it, so those of one word more decide.
    inner = long.where(F.size("words") > 2).select(
        "lang", "f", F.explode(F.array(
            F.concat_ws(" ", F.slice("words", F.lit(1), F.size("words") - 1)),
            F.concat_ws(" ", F.slice("words", F.lit(2), F.size("words") - 1)),
        )).alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (F.lit(100) * F.col("around") < F.lit(absorb) * F.col("a")))
    return kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def mine_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", id: str | None = None, least: int = LEAST, longest: int = LONGEST,
    top: int = TOP, absorb: int = ABSORB, **options,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` collocations of each language.

    A-Z are lower-cased; words are what spaces and tabs part, phrases end at ``.,;:!?`` and line ends. A
    phrase of 2 to ``longest`` words with ``a >= least`` occurrences scores floor(1000 a n / (l r)), l and r the
    occurrences of its parts, n all words of the language. Ties go by more occurrences, then by bytes. Other
    columns of ``docs`` play no part; an empty table, like null or empty texts, gives no rows.
    """
    scored = score_phrases(frequent_phrases(docs, text, lang, id, least, longest, **options), absorb)
    ordered = scored.withColumns({"_score": -F.col("score"), "_a": -F.col("a")})
    ranked = number_rows(ordered, ["lang"], ["_score", "_a", "phrase"], "rank").where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
