"""SentencePiece encoding and decoding of BPE models by a streaming Viterbi pass.

The lattice has one node per character boundary and one edge per piece. In a BPE encoding two
neighbouring pieces are exactly those that merging their joint text leaves apart, so an edge may
follow another only if their pair merges into itself; this leaves one best path into each node.
A node never looks back further than the longest piece. As soon as the paths into all nodes that
later pieces can start from run through one boundary, everything before it is given out and forgotten.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = "▁"
# Segments and pairs remembered by a worker, twice: when so many are new, the older half is forgotten.
# Longer segments are not remembered.
MEMO_LIMIT = 250_000
MEMO_CHARS = 48
LATIN_END = 0x250
_BEYOND_LATIN = re.compile(f"[^\0-{chr(LATIN_END - 1)}]")
_NONE = -1


@dataclass
class Model:
    """What encoding and decoding need of a model file; bounded by its vocabulary."""

    ids: dict[str, int]  # pieces that text can be encoded into
    scores: dict[str, float]  # all pieces that merging may form
    byte_ids: list[int]
    surface: list[bytes]  # text of each id
    dummy_prefix: bool
    alone: list[str]  # of the pieces, those that merge into themselves


def read_model(path: str) -> Model:
    """Read a BPE model with byte fallback, identity normalisation and no user-defined pieces."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules, spec = model.normalizer_spec, model.trainer_spec
    plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.escape_whitespaces
    kinds = {p.type for p in model.pieces}
    if spec.model_type != 2 or not spec.byte_fallback or spec.treat_whitespace_as_suffix or not plain or kinds - {1, 2, 3, 6}:
        raise ValueError("only BPE models with byte fallback, plain normalisation and no user-defined pieces")
    ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
    scores = {p.piece: p.score for p in model.pieces if p.type == 1}
    byte_ids, surface = [0] * 256, []
    for number, piece in enumerate(model.pieces):
        if piece.type == 6:
            byte_ids[int(piece.piece[1:-1], 16)] = number
            surface.append(bytes([int(piece.piece[1:-1], 16)]))
        else:
            surface.append(piece.piece.replace(SPACE, " ").encode() if piece.type == 1 else b"")
    alone = [p for p in ids if merge(p, scores) == [p]]
    return Model(ids, scores, byte_ids, surface, rules.add_dummy_prefix, alone)


def merge(text: str, scores: dict[str, float], until: int = 1) -> list[str]:
    """Pieces of a short text by merging the best-scored neighbours first, leftmost among equals;
    stops when ``until`` pieces are left."""
    parts = list(text)
    while len(parts) > until:
        best, at = None, -1
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def _segments(pieces: list[str], below: int = 0x110000) -> re.Pattern:
    """How text of characters under ``below`` is cut into segments that no piece crosses, proved from the pieces.

    Where no piece has a space behind another character, every word start is a boundary; where a line
    break stands in no longer piece, it is a segment of its own; and characters other than letters
    that follow only each other or a space within pieces start a segment after anything else.
    """
    behind: dict[str, set[str]] = {}
    for piece in pieces:
        for before, character in zip(piece, piece[1:]):
            behind.setdefault(character, set()).add(before)
    if behind.get(SPACE, set()) - {SPACE}:
        return re.compile(".+", re.DOTALL)
    alone = "\n" if not any("\n" in p and len(p) > 1 for p in pieces) else ""
    marks = {c for p in pieces for c in p if unicodedata.category(c)[0] not in "LM"} - {SPACE, "\n"}
    while crossed := {m for m in marks if behind.get(m, set()) - marks - {SPACE}}:
        marks -= crossed
    mark = "".join(re.escape(m) for m in sorted(marks) if ord(m) < below)
    single = f"{alone}|" if alone else ""
    if not mark:
        return re.compile(f"{single}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+")
    return re.compile(f"{single}{SPACE}*[{mark}]*[^{SPACE}{alone}{mark}]+|{SPACE}*[{mark}]+|{SPACE}+")


class Encoder(dict):
    """Ids of a segment of normalised text, as int32 bytes; remembers short segments."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.pieces = {p: model.ids[p] for p in model.alone}
        self.names = {i: p for p, i in self.pieces.items()}
        self.longest = max(map(len, self.pieces), default=1)
        # The longest piece that ends in these three characters bounds how far a node looks back.
        self.reach: dict[str, int] = {}
        for piece in self.pieces:
            if len(piece) > 2:
                self.reach[piece[-3:]] = max(self.reach.get(piece[-3:], 2), len(piece))
        turns = {score: turn for turn, score in enumerate(sorted(set(model.scores.values()), reverse=True))}
        self.turn = {p: turns[score] for p, score in model.scores.items()}
        self.halves: dict[str, tuple[str, str]] = {}
        self.pairs: dict[int, bool] = {}
        self.older: dict[str, bytes] = {}
        self.older_pairs: dict[int, bool] = {}
        # The same cuts in a smaller class for texts of Latin characters.
        self.segments, self.latin_segments = _segments(list(model.scores)), _segments(list(model.scores), LATIN_END)

    def __missing__(self, segment: str) -> bytes:
        ids = self.older.get(segment)
        if ids is None:
            whole = self.pieces.get(segment)
            ids = array("i", (whole,) if whole is not None else self.stream(segment)).tobytes()
        if len(segment) <= MEMO_CHARS:
            if len(self) >= MEMO_LIMIT:
                self.older = dict(self)
                self.clear()
            self[segment] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        pattern = self.segments if _BEYOND_LATIN.search(text) else self.latin_segments
        normal = text.replace(" ", SPACE)
        if self.model.dummy_prefix:
            normal = SPACE + normal
        return b"".join(map(self.__getitem__, pattern.findall(normal)))

    def agree(self, key: int) -> bool:
        """Whether two pieces, ``before << 32 | after``, stay apart when their joint text is merged."""
        known = self.older_pairs.get(key)
        if known is None:
            known = self._apart(self.names[key >> 32], self.names[key & 0xFFFFFFFF])
        if len(self.pairs) >= MEMO_LIMIT:
            self.older_pairs = dict(self.pairs)
            self.pairs.clear()
        self.pairs[key] = known
        return known

    def _apart(self, one: str, two: str) -> bool:
        """Whether merging ``one + two`` never joins characters across the two.

        Merges are undone from the last: whatever stood next to the border when a later merge took
        place was not joined over the border, unless that join had its turn before. Of two merges
        with the same turn the left one comes first.
        """
        turn = self.turn
        limit = len(turn) + 1
        while True:
            joint = turn.get(one + two)
            if joint is not None and joint < limit:
                return False
            made_one = turn[one] if len(one) > 1 else -1
            made_two = turn[two] if len(two) > 1 else -1
            if made_one < 0 and made_two < 0:
                return True
            if made_one > made_two:
                limit, one = made_one, self._half(one)[1]
            else:
                limit, two = made_two + 1, self._half(two)[0]

    def _half(self, piece: str) -> tuple[str, str]:
        """The two parts whose merge made ``piece``."""
        halves = self.halves.get(piece)
        if halves is None:
            first, second = merge(piece, self.model.scores, 2)
            halves = self.halves[piece] = (first, second)
        return halves

    def stream(self, text: str) -> Iterator[int]:
        """Ids of ``text``, given out as soon as they are certain."""
        start, last, size = 0, [_NONE], [0]
        step = 4 * self.longest
        for end in range(min(step, len(text)), len(text), self.longest):
            self._extend(text, start, end, last, size)
            shared = self._shared(size)
            if shared:
                yield from self._path(text, start, last, size, shared)
                start, last, size = start + shared, last[shared:], size[shared:]
        self._extend(text, start, len(text), last, size)
        yield from self._path(text, start, last, size, len(size) - 1)

    def _extend(self, text: str, start: int, end: int, last: list[int], size: list[int]) -> None:
        """Take the lattice on to boundary ``end``.

        ``last[k]`` and ``size[k]`` are the last piece of the path into boundary start + k, and its length.
        """
        pieces, reach, pairs = self.pieces, self.reach, self.pairs
        for to in range(start + len(last), end + 1):
            length = reach.get(text[to - 3 : to], 2) if to > 2 else 2
            if length > to - start:
                length = to - start
            while length:
                piece = pieces.get(text[to - length : to])
                if piece is not None:
                    before = last[-length]
                    if before == _NONE:
                        break
                    key = before << 32 | piece
                    agree = pairs.get(key)
                    if agree or (agree is None and self.agree(key)):
                        break
                length -= 1
            if length:
                last.append(piece)
                size.append(length)
            else:  # no piece: the character is spelled in bytes
                last.append(_NONE)
                size.append(1)

    def _shared(self, size: list[int]) -> int:
        """The boundary on which the paths into the last nodes converge (0: only where they start)."""
        open_nodes = set(range(max(len(size) - self.longest, 0), len(size)))
        while len(open_nodes) > 1:
            latest = max(open_nodes)
            open_nodes.remove(latest)
            open_nodes.add(latest - size[latest])
        return open_nodes.pop()

    def _path(self, text: str, start: int, last: list[int], size: list[int], end: int) -> list[int]:
        """Ids of the path into boundary start + ``end``."""
        path: list[int] = []
        while end:
            piece = last[end]
            if piece == _NONE:
                path.extend(self.model.byte_ids[byte] for byte in reversed(text[start + end - 1].encode()))
            else:
                path.append(piece)
            end -= size[end]
        path.reverse()
        return path


def decode(ids: list[int], model: Model) -> str:
    """Text of ids; the inverse of encoding for every text without U+2581, which is read as a space."""
    raw = b"".join(map(model.surface.__getitem__, ids))
    if model.dummy_prefix and raw[:1] == b" ":
        raw = raw[1:]
    return raw.decode("utf-8", "replace")


_encoders: dict[int, Encoder] = {}


class Tokenizer:
    """Column forms of encoding and decoding for the model file at ``path`` on the driver."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.shipped = spark.sparkContext.broadcast(read_model(path))

    def encode(self, text: Column | str) -> Column:
        """array<int> of piece ids without begin or end marks; equal to the library's. A null or empty text has none."""
        shipped = self.shipped

        @F.arrow_udf("array<int>")
        def run(texts):
            model = shipped.value
            encoder = _encoders.get(id(model))
            if encoder is None:
                _encoders.clear()
                encoder = _encoders[id(model)] = Encoder(model)
            parts = [encoder.encode(t.as_py()) for t in texts]
            offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in parts]))).astype(np.int32)
            values = np.frombuffer(b"".join(parts), dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

        # Called so, a plan that reads the ids twice still encodes once.
        return run.asNondeterministic()(text)

    def decode(self, ids: Column | str) -> Column:
        """Text of an array of ids; null and empty arrays give the empty text."""
        shipped = self.shipped

        @F.arrow_udf("string")
        def run(lists):
            model = shipped.value
            bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            given = lists.is_valid().to_numpy(zero_copy_only=False)
            return pa.array(
                [decode(flat[a:b].tolist(), model) if here else "" for a, b, here in zip(bounds, bounds[1:], given)], pa.string())

        return run(ids)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the piece ids of ``text``; an input column named like ``ids`` is replaced."""
    return docs.withColumn(ids, Tokenizer(docs.sparkSession, path).encode(F.col(f"`{text}`")))
