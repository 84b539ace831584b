"""Hiding of a whole table of secrets in texts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborsync.functions.masking import MASK

# Secrets are sent to the tasks in blocks of so many bytes.
BLOCK_BYTES = 8 << 20


# Stretches of up to so many characters are remembered, so many of them at a time.
STRETCH_CHARS, STRETCHES = 64, 1 << 17


class Masker(dict):
    """Masks ``secrets``, which come longest first; holds masked stretches of the texts seen last.

    A stretch is a longest run of characters that secrets hold. No match crosses the ends of one, so each
    is masked by itself, and what is the same in many texts, such as a word, is masked once.
    """

    def __init__(self, secrets: list[str]) -> None:
        import ahocorasick

        super().__init__()
        self.lengths = [len(secret) for secret in secrets]
        self.stretches = re.compile(f"([{re.escape(''.join(sorted(set().union(*secrets))))}]+)")
        self.automaton = ahocorasick.Automaton()
        for rank, secret in enumerate(secrets):
            self.automaton.add_word(secret, rank)
        self.automaton.make_automaton()

    def mask(self, text: str) -> str:
        # Every other part is a stretch.
        parts = self.stretches.split(text)
        parts[1::2] = map(self.__getitem__, parts[1::2])
        return "".join(parts)

    def __missing__(self, stretch: str) -> str:
        masked = self.hide(stretch)
        if len(stretch) <= STRETCH_CHARS:
            if len(self) >= STRETCHES:
                self.clear()
            self[stretch] = masked
        return masked

    def hide(self, text: str) -> str:
        """``text`` with all matches masked, by rank, then from the left. What is masked already is no part of a further match."""
        found = sorted((rank, last) for last, rank in self.automaton.iter(text))
        if not found:
            return text
        taken = bytearray(len(text))
        chosen = []
        for rank, last in found:
            length = self.lengths[rank]
            begin = last - length + 1
            # A longer match comes first, so one that meets it covers one of its own ends.
            if not taken[begin] and not taken[last]:
                taken[begin : last + 1] = b"\x01" * length
                chosen.append((begin, last + 1))
        out, at = [], 0
        for begin, end in sorted(chosen):
            out += (text[at:begin], MASK)
            at = end
        return "".join(out) + text[at:]


_maskers: dict[str, Masker] = {}


def _masker(block) -> Masker:
    """Built once for each Python worker and block."""
    if block.id not in _maskers:
        _maskers.clear()
        _maskers[block.id] = Masker(block.value)
    return _maskers[block.id]


class _Sent:
    """A broadcast block with a name of its own, the same in every task."""

    def __init__(self, held) -> None:
        self.held, self.id = held, uuid.uuid4().hex

    @property
    def value(self) -> list[str]:
        return self.held.value


def _mask(column: int, block: _Sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masker = _masker(block)
        for batch in batches:
            texts = batch.column(column)
            masked = (None if text is None else masker.mask(text) for text in (texts[i].as_py() for i in range(len(texts))))
            columns = list(batch.columns)
            columns[column] = pa.array(masked, texts.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return run


def _blocks(secrets: DataFrame, block_bytes: int) -> Iterator[list[str]]:
    held, size = [], 0
    for row in secrets.toLocalIterator():
        held.append(row[0])
        size += len(row[0].encode())
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def mask_secret_table(rows: DataFrame, column: str, secrets: DataFrame, secret: str = "secret", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``rows`` with every value of ``secrets`` masked in the string ``column``, longest values first, equally long ones in order.

    All values of a block are looked for in one pass over a text, however many they are. Null and empty values
    are none. The driver sees one block of secrets at a time; blocks are applied one after the other, longest first.
    """
    value = F.col(f"`{secret}`").cast("string")
    ordered = secrets.select(value.alias("s")).where("s <> ''").distinct().orderBy(F.char_length("s").desc(), "s")
    at = rows.columns.index(column)
    for block in _blocks(ordered, block_bytes):
        sent = _Sent(rows.sparkSession.sparkContext.broadcast(block))
        rows = rows.mapInArrow(_mask(at, sent), rows.schema)
    return rows
