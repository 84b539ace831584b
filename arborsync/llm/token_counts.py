"""Token counts of byte-level BPE by the whole-token shortcut.

Most pre-tokens of a text are vocabulary strings that encode alone as one token. That is proved for
the whole vocabulary before the job starts; in the job such pre-tokens are looked up, and only the
rest is merged.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Fixed value: how byte-level BPE cuts text into pre-tokens before merging.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Where the installed regex module and the tokenizer library classify every character alike, as
# tests/llm/test_token_counts.py checks one by one; a text with others is left to the library.
AGREED = "\u0000-՗‐-⁤₠-₾　-ヿ一-鿕가-힣"
_DISPUTED = regex.compile(f"[^{AGREED}]")
# The same cuts for texts of Latin characters only, with the classes spelled out for the faster module.
_SPACE = r"\t-\r \x85\xa0"
_LETTER, _NUMBER = r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN = "\u0000-\u024f\u2010-\u2027\u20ac"
_NOT_LATIN = re.compile(f"[^{LATIN}]")
LATIN_PRE_TOKEN = re.compile(
    rf" ?[{_LETTER}]+| ?[{_NUMBER}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# A pre-token always starts at a single space between two non-spaces.
_CUT = regex.compile(r"(?<=\S) (?=\S)")
CHUNK_CHARS = 1 << 18
# Merged pre-tokens remembered by a worker before it starts afresh.
MEMO_LIMIT = 400_000


def byte_alphabet() -> dict[int, str]:
    """The printable character by which byte-level BPE writes each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def whole_tokens(model: str) -> list[str]:
    """The vocabulary strings proved to encode alone as one token: a single pre-token that merges into itself.

    ``model`` is the text of a tokenizer file. The result is bounded by its vocabulary.
    """
    tokenizer = Tokenizer.from_str(model)
    to_byte = {c: b for b, c in byte_alphabet().items()}
    proved = []
    for written in tokenizer.get_vocab(with_added_tokens=False):
        try:
            plain = bytes(to_byte[c] for c in written).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        alone = PRE_TOKEN.findall(plain) == [plain] and not _DISPUTED.search(plain)
        if alone and [t.value for t in tokenizer.model.tokenize(written)] == [written]:
            proved.append(plain)
    return proved


class Counter(dict):
    """Tokens by pre-token. Starts with the proved strings; merges others when first met."""

    def __init__(self, model: str, proved: list[str]) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_str(model)
        self.proved = dict.fromkeys(proved, 1)
        self.update(self.proved)
        alphabet = byte_alphabet()
        self.write = {i: alphabet[i] for i in range(256)}
        added = self.tokenizer.get_added_tokens_decoder().values()
        # Tokens with looser matching rules than "this very string" would need the library's own search.
        self.plain_specials = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added)
        strings = sorted((t.content for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, strings))) if strings else None

    def __missing__(self, piece: str) -> int:
        if len(self) > MEMO_LIMIT + len(self.proved):
            self.clear()
            self.update(self.proved)
        written = piece.encode().decode("latin-1").translate(self.write)
        count = self[piece] = len(self.tokenizer.model.tokenize(written))
        return count

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; null and empty texts have none."""
        if not text:
            return 0
        if not self.plain_specials:
            return self.by_library(text)
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(map(self._count_plain, parts))

    def _count_plain(self, text: str) -> int:
        pattern = PRE_TOKEN if _NOT_LATIN.search(text) else LATIN_PRE_TOKEN
        if pattern is PRE_TOKEN and _DISPUTED.search(text):
            return self.by_library(text)
        return sum(sum(map(self.__getitem__, pattern.findall(chunk))) for chunk in chunks(text))

    def by_library(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


def chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """Pieces of about ``size`` characters, cut only where a pre-token starts."""
    begin = 0
    while len(text) - begin > size:
        cut = _CUT.search(text, begin + size)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


# The counter of the file a worker was last given.
_counters: dict[int, tuple[tuple, Counter]] = {}


def token_count(spark, text: Column | str, path: str) -> Column:
    """Number of tokens of a text column under the byte-level BPE file at ``path`` on the driver.

    Equal to the library's count without begin, end or added special tokens; strings of special
    tokens inside a text count as that token, the library's default. Null and empty texts have 0.
    What is sent to the workers is the file and its proved strings, bounded by the vocabulary.
    """
    with open(path, encoding="utf-8") as file:
        model = file.read()
    kind = json.loads(model)["pre_tokenizer"]
    if kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex", True):
        raise ValueError("the shortcut is proved for plain byte-level pre-tokens")
    shipped = spark.sparkContext.broadcast((model, whole_tokens(model)))

    @F.arrow_udf("long")
    def count(texts):
        given = shipped.value
        held, counter = _counters.get(id(given), (None, None))
        if held is not given:
            _counters.clear()
            counter = Counter(*given)
            _counters[id(given)] = given, counter
        return pa.array([counter.count(t.as_py()) for t in texts], pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """Add n_bytes, n_tokens and over_limit (n_tokens > ``limit``); input columns of these names are replaced."""
    tokens = token_count(docs.sparkSession, F.col(text), path)
    sized = docs.withColumns({
        "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"),
        "n_tokens": tokens,
    })
    return sized.withColumn("over_limit", F.col("n_tokens") > limit)
