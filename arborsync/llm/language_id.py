"""Language of texts by a linear-chain conditional random field over words.

A word's emission score sums learned weights of its affixes, character n-grams and lexicon entry;
learned transitions tie neighbours together, so that a code-switched text is labelled word by word.
Training chains join windows of different documents, which is where switches come from. All work is
numpy over whole slices of texts; many chains, cut into blocks, go through forward-backward at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborsync.llm.words import LETTERS, SLICE_BYTES, Words, mix, slices, split_words

UNKNOWN = "und"
BUCKETS = 1 << 16  # weights of hashed features, per language
GRAMS = (2, 3, 4)  # bytes of an n-gram; a mark stands before and after the word, so affixes are n-grams too
ROWS_PER_LANGUAGE = 300  # documents of the training sample, for each language (in expectation)
WINDOW_WORDS = 200  # words taken from one of them
LEXICON_FROM = 4  # occurrences in the sample that make a word a lexicon entry
ROUNDS = 25
BLOCK = 96  # words of a chain that are worked through in order
LEAD_WORDS = 8  # a text that switches in the middle is told by how it opens, as far as the sample bears that out
LEADS = (0.0, 0.1, 0.2, 0.3, 0.5, 0.8, 1.2)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    lexicon: np.ndarray  # sorted hashes of known words
    known: np.ndarray  # words of the lexicon x languages
    transitions: np.ndarray  # languages x languages, scores
    start: np.ndarray
    lead: float = 0.0  # weight of the opening words in the language of a text


def _features(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, offsets) of the n-gram and affix features of the ``chosen`` words, at least one for each."""
    starts, lengths = words.starts[chosen], words.lengths[chosen]
    size = lengths + 2
    offset = np.cumsum(size) - size
    raw = np.frombuffer(words.data, dtype=np.uint8)
    total = int(size.sum())
    letters = np.empty(total + max(GRAMS), dtype=np.uint64)
    inside = np.arange(total) - np.repeat(offset, size)
    letters[:total] = raw[np.minimum(np.repeat(starts, size) + np.maximum(inside - 1, 0), len(raw) - 1)]
    letters[offset] = 2
    letters[offset + size - 1] = 3
    letters[total:] = 0
    left = np.repeat(size, size) - inside
    owner = np.repeat(np.arange(len(chosen)), size)
    buckets, owners = [], []
    for gram in GRAMS:
        at = np.flatnonzero(left >= gram)
        code = np.full(len(at), gram, dtype=np.uint64)
        for step in range(gram):
            code = (code << np.uint64(8)) | letters[at + step]
        buckets.append((mix(code) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[at])
    bucket, own = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return bucket[order], np.searchsorted(own[order], np.arange(len(chosen)))


def _lexicon_rows(model_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Row of each hash in the sorted lexicon, -1 if it is none."""
    if not len(model_words):
        return np.full(len(hashes), -1)
    row = np.minimum(np.searchsorted(model_words, hashes), len(model_words) - 1)
    return np.where(model_words[row] == hashes, row, -1)


def _emissions(model: Model, words: Words) -> np.ndarray:
    """Scores (words x languages); each distinct word is scored once."""
    distinct, first, place = np.unique(words.hashes, return_index=True, return_inverse=True)
    bucket, offsets = _features(words, first)
    score = np.add.reduceat(model.weights[bucket], offsets, axis=0)
    row = _lexicon_rows(model.lexicon, distinct)
    score[row >= 0] += model.known[row[row >= 0]]
    return score[place]


def _pass(score: np.ndarray, opens: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward and backward messages and potentials (words x languages) of consecutive chains.

    ``opens`` marks the first word of a chain. The words are cut into blocks of ``BLOCK``; first the
    transfer matrix of every block is multiplied up, then messages are carried from block to block,
    and last all blocks run through their words side by side. Arrays are (step, language, block).
    """
    count, labels = score.shape
    blocks = -(-count // BLOCK)
    padded = np.zeros((blocks * BLOCK, labels))
    padded[:count] = np.maximum(score - score.max(axis=1, keepdims=True), -60.0)
    potential = np.exp(padded.reshape(blocks, BLOCK, labels).transpose(1, 2, 0), order="C")
    fresh = np.ones(blocks * BLOCK, dtype=bool)
    fresh[:count] = opens
    fresh = np.ascontiguousarray(fresh.reshape(blocks, BLOCK).T)
    move, first = np.exp(transitions), np.exp(start)[:, None]

    transfer = np.zeros((labels, labels, blocks))  # state now, state before the block, block
    transfer[np.arange(labels), np.arange(labels)] = 1
    for step in range(BLOCK):
        on = (move.T @ transfer.reshape(labels, -1)).reshape(labels, labels, blocks)
        reset = np.flatnonzero(fresh[step])
        on[:, :, reset] = first[:, :, None] * transfer[:, :, reset].sum(axis=0)
        transfer = on * potential[step][:, None, :]
        if step % 4 == 3:
            transfer /= transfer.max(axis=(0, 1))
    enter, leave = np.empty((labels, blocks)), np.empty((labels, blocks))
    through = np.ascontiguousarray(transfer.transpose(2, 0, 1))
    message = np.full(labels, 1.0 / labels)
    for block in range(blocks):
        enter[:, block] = message
        message = through[block] @ message
        message /= message.sum()
    message = np.ones(labels)
    for block in range(blocks - 1, -1, -1):
        leave[:, block] = message
        message = message @ through[block]
        message /= message.max()

    forward, backward = np.empty_like(potential), np.empty_like(potential)
    message = enter
    for step in range(BLOCK):
        message = np.where(fresh[step], first * message.sum(axis=0), move.T @ message) * potential[step]
        message /= message.sum(axis=0)
        forward[step] = message
    message = leave
    for step in range(BLOCK - 1, -1, -1):
        backward[step] = message
        ahead = potential[step] * message
        message = np.where(fresh[step], (first * ahead).sum(axis=0), move @ ahead)
        message /= message.max(axis=0)
    flat = lambda a: a.transpose(2, 0, 1).reshape(blocks * BLOCK, labels)[:count]
    return flat(forward), flat(backward), flat(potential)


def _marginals(forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True)


def label_texts(model: Model, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(share of each language, number of words) of each text: its expected share among all words,
    averaged with that among the opening words by the weight ``model.lead``."""
    share, lead, sizes = _shares(model, texts)
    return (share + model.lead * lead) / (1 + model.lead), sizes


def _shares(model: Model, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = split_words(texts, LETTERS)
    sizes = np.diff(words.bounds)
    share = np.zeros((len(texts), len(model.languages)))
    lead = np.zeros_like(share)
    if len(words.hashes):
        opens = np.zeros(len(words.hashes), dtype=bool)
        full = np.flatnonzero(sizes)
        first = words.bounds[full]
        opens[first] = True
        forward, backward, _ = _pass(_emissions(model, words), opens, model.transitions, model.start)
        marginal = _marginals(forward, backward)
        share[full] = np.add.reduceat(marginal, first, axis=0) / sizes[full, None]
        begin = np.minimum(sizes[full], LEAD_WORDS)
        total = np.vstack((np.zeros((1, marginal.shape[1])), np.cumsum(marginal, axis=0)))
        lead[full] = (total[first + begin] - total[first]) / begin[:, None]
    return share, lead, sizes


@dataclass
class _Adam:
    """Step sizes by running moments of the gradient."""

    rate: float
    moments: dict[str, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    steps: int = 0

    def update(self, name: str, value: np.ndarray, gradient: np.ndarray) -> None:
        first, second = self.moments.get(name, (np.zeros_like(value), np.zeros_like(value)))
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        self.moments[name] = first, second
        value += self.rate * (first / (1 - 0.9**self.steps)) / (np.sqrt(second / (1 - 0.99**self.steps)) + 1e-8)


def train(rows: list[tuple[bytes, str]], rounds: int = ROUNDS, seed: int = 7) -> Model | None:
    """Fit the field on (lower-cased text, language) rows by gradient ascent on the likelihood of whole chains."""
    languages = sorted({language for _, language in rows})
    if not languages:
        return None
    draw = np.random.default_rng(seed)
    words = split_words([text for text, _ in rows], LETTERS)
    sizes = np.diff(words.bounds)
    windows = []
    for row in np.flatnonzero(sizes).tolist():
        begin, end = int(words.bounds[row]), int(words.bounds[row + 1])
        if end - begin > WINDOW_WORDS:
            begin += int(draw.integers(0, end - begin - WINDOW_WORDS + 1))
            end = begin + WINDOW_WORDS
        while begin < end:
            stop = min(begin + int(draw.integers(8, 40)), end)
            windows.append((begin, stop, languages.index(rows[row][1])))
            begin = stop
    draw.shuffle(windows)
    chosen = np.concatenate([np.arange(a, b) for a, b, _ in windows])
    gold = np.concatenate([np.full(b - a, label) for a, b, label in windows])
    opens = np.zeros(len(chosen), dtype=bool)
    lengths = np.array([b - a for a, b, _ in windows])
    opens[(np.cumsum(lengths) - lengths)[::3]] = True  # three windows make a chain

    count = len(languages)
    hashes = words.hashes[chosen]
    distinct, first, place, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    bucket, offsets = _features(words, chosen[first])
    owner = np.repeat(np.arange(len(distinct)), np.diff(np.append(offsets, len(bucket))))
    lexicon = distinct[times >= LEXICON_FROM]
    row = _lexicon_rows(lexicon, distinct)
    model = Model(
        languages, np.zeros((BUCKETS, count)), lexicon, np.zeros((len(lexicon), count)), np.zeros((count, count)), np.zeros(count))
    target = np.zeros((len(gold), count))
    target[np.arange(len(gold)), gold] = 1
    inner = np.flatnonzero(~opens)
    seen = np.zeros((count, count))
    np.add.at(seen, (gold[inner - 1], gold[inner]), 1)
    adam = _Adam(0.15)
    for _ in range(rounds):
        score = np.add.reduceat(model.weights[bucket], offsets, axis=0)
        score[row >= 0] += model.known[row[row >= 0]]
        forward, backward, potential = _pass(score[place], opens, model.transitions, model.start)
        marginal = _marginals(forward, backward)
        pair = forward[inner - 1][:, :, None] * np.exp(model.transitions) * (potential[inner] * backward[inner])[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        rest = target - marginal
        by_word = np.column_stack([np.bincount(place, rest[:, k], len(distinct)) for k in range(count)])
        by_bucket = np.column_stack([np.bincount(bucket, by_word[owner, k], BUCKETS) for k in range(count)])
        adam.steps += 1
        adam.update("weights", model.weights, by_bucket - 0.1 * model.weights)
        adam.update("known", model.known, by_word[row >= 0] - 0.1 * model.known)
        adam.update("transitions", model.transitions, seen - pair.sum(axis=0) - 0.1 * model.transitions)
        adam.update("start", model.start, (target[opens] - marginal[opens]).sum(axis=0) - 0.1 * model.start)
    model.weights = model.weights.astype(np.float32)
    share, lead, sizes = _shares(model, [text for text, _ in rows])
    truth = np.array([languages.index(language) for _, language in rows])
    right = [((share + weight * lead).argmax(axis=1) == truth)[sizes > 0].sum() for weight in LEADS]
    model.lead = LEADS[int(np.argmax(right))]
    return model


def _normal(text: Column) -> Column:
    return F.lower(text).cast("binary")


def _has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def fit(labelled: DataFrame, id: str, text: str, language: str, rows: int = ROWS_PER_LANGUAGE) -> Model | None:
    """Fit on a bounded sample of ``labelled``: about ``rows`` documents of each language, chosen by a hash of the id."""
    body = F.col(f"`{text}`")
    usable = labelled.where(F.col(f"`{language}`").isNotNull() & _has_letter(body))
    # One count per language.
    counts = {r["language"]: r["n"] for r in usable.groupBy(F.col(f"`{language}`").alias("language")).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    chance = F.lit(0.0)
    for name, count in counts.items():
        chance = F.when(F.col(f"`{language}`") == name, F.lit(rows / count)).otherwise(chance)
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(f"`{id}`")), F.lit(1 << 20)) / F.lit(1 << 20)
    sample = usable.where(place < chance).select(F.col(f"`{language}`").alias("language"), _normal(body).alias("text"))
    return train(sorted((bytes(r["text"]), r["language"]) for r in sample.collect()))


def _pieces(text: bytes | None) -> list[bytes | None]:
    """A very long text in pieces of about a slice, cut between words; each is a chain of its own."""
    if text is None or len(text) <= SLICE_BYTES:
        return [text]
    pieces, begin = [], 0
    while len(text) - begin > SLICE_BYTES:
        cut = text.find(b" ", begin + SLICE_BYTES)
        if cut < 0:
            break
        pieces.append(text[begin:cut])
        begin = cut
    return [*pieces, text[begin:]]


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add lang_pred and score (its expected share of the words) of every whole text.

    A text that is null or has no letter is ``und`` with score 0; so is every text if nothing could
    be learned. Ties go to the first language by name. Columns of these names are replaced.
    """
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages, and the sample's lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            for begin, texts in slices(batch, "_bytes"):
                parts = [piece for text in texts for piece in _pieces(text)]
                owner = np.repeat(np.arange(len(texts)), [len(_pieces(text)) for text in texts]) if len(parts) > len(texts) else None
                share, sizes = label_texts(model, parts)
                if owner is not None:
                    weighted, share = share * sizes[:, None], np.zeros((len(texts), len(model.languages)))
                    np.add.at(share, owner, weighted)
                    share /= np.maximum(np.bincount(owner, sizes, len(texts)), 1)[:, None]
                best = share.argmax(axis=1)
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([model.languages[k] for k in best], pa.string()),
                        pa.array(np.clip(share[np.arange(len(texts)), best], 0.0, 1.0)),
                    ],
                    names=["_row", "lang_pred", "score"],
                )

    plain = docs.drop("lang_pred", "score")
    packed = plain.select(
        F.struct(*[F.col(f"`{c}`") for c in plain.columns], _has_letter(F.col(f"`{text}`")).alias("_letters")).alias("_row"),
        _normal(F.col(f"`{text}`")).alias("_bytes"),
    )
    row = packed.schema["_row"].dataType.simpleString()
    found = packed.mapInArrow(run, f"_row {row}, lang_pred string, score double").select("_row.*", "lang_pred", "score")
    return found.withColumns({
        "lang_pred": F.when(F.col("_letters"), F.col("lang_pred")).otherwise(UNKNOWN),
        "score": F.when(F.col("_letters"), F.col("score")).otherwise(0.0),
    }).drop("_letters")
