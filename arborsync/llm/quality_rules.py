"""Quality rules: a table of thresholds, compiled into JVM-side projections over length, symbol, stop-word and line ratios."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
WINDOW = 5

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it was for on are as with by be this from or an "
    "der die das und ist ein eine nicht mit von zu den auf für sich dem "
    "le la les de des et un une du que qui dans pour sur au "
    "el los las y en del por con para se una"
).split()
# Of other languages that are written with the same letters.
FURTHER_STOP_WORDS = (
    "het een van dat zijn il che di non della os da do em och att som det til ja ei na nie si cu din az hogy ve bir bu "
    "yang dan itu dengan untuk dari ini ang ng sa mga ya wa kwa ni est cum yn agus eta iyo ny sy"
).split()
# The letters of these languages, composed or not. A text with more than this share of others is in a
# language that the lists do not know.
LETTERS = "a-zA-ZäöüßÄÖÜẞàâæçéèêëîïôœùûÿÀÂÆÇÉÈÊËÎÏÔŒÙÛŸáíñóúÁÍÑÓÚ\\u0300-\\u0303\\u0308\\u0327"
OTHER_LETTERS = 0.02
LEAST_STOPS = 0.01


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie in [low, high] for texts of at least ``from_words`` words; None leaves a side open."""

    metric: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


RULES = (
    Rule("n_words", low=10),
    Rule("repeat_ratio", high=0.2),
    Rule("symbol_ratio", high=0.05),
    Rule("exclaim_ratio", high=0.1),
    Rule("mean_word_chars", low=1.5, high=60),
    Rule("dup_line_ratio", high=0.6),
    Rule("stop_ratio", low=LEAST_STOPS, from_words=100),
)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, characters: str) -> Column:
    """``text`` less single characters; plain replacement reads bytes and starts no regular expression."""
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def _unknown(text: Column) -> Column:
    """Whether more than ``OTHER_LETTERS`` of the letters of ``text`` are in no language of the stop words."""
    letters = F.char_length(F.regexp_replace(text, "[^\\p{L}\\p{M}]+", ""))
    others = F.char_length(F.regexp_replace(text, f"[{LETTERS}]+|[^\\p{{L}}\\p{{M}}]+", ""))
    return others > OTHER_LETTERS * letters


def measure(docs: DataFrame, text: str = "text", stop_words: Sequence[str] = (*STOP_WORDS, *FURTHER_STOP_WORDS)) -> DataFrame:
    """Add the counts and ratios that rules refer to.

    Words are runs of anything but ASCII white space. A null or empty text has zero in every
    count and ratio. Stop words count in any case; stop_ratio is null for a text with next to none
    whose letters show a language that the list does not know. Added columns replace input columns
    of the same name.
    """
    stops = sorted({w.lower() for w in stop_words})
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))
    step = docs.withColumns({"_body": body, "_words": words, "_n": F.octet_length(body)})
    found = step.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.char_length(F.regexp_replace(body, SPACE_RUN, "")).cast("bigint"),
        "n_symbols": (F.col("_n") - F.octet_length(_without(body, SYMBOLS))).cast("bigint"),
        "_exclaims": F.col("_n") - F.octet_length(_without(body, "!")),
        "_lines": F.filter(F.split(body, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")),
        "_stops": F.size(F.filter("_words", lambda word: F.lower(word).isin(stops))),
        "_windows": F.when(
            F.size("_words") >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size("_words") - WINDOW + 1),
                        lambda i: F.xxhash64(F.slice("_words", i, WINDOW))),
        ),
    })
    # Only texts in which a window recurs pay for sorting their windows.
    recurs = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = found.withColumn("_sorted", F.when(recurs, F.array_sort(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = lambda p, k: (
        (p["h"] == F.get("_sorted", k - 1)["h"]).eqNullSafe(True) | (p["h"] == F.get("_sorted", k + 1)["h"]).eqNullSafe(True)
    )
    marked = ordered.withColumn("_starts", F.array_sort(F.transform(F.filter("_sorted", twin), lambda p: p["i"])))
    # Each recurring window covers the words up to the next one, five at most; the last covers five.
    covers = F.zip_with("_starts", F.slice("_starts", F.lit(2), F.size("_starts")), lambda a, b: F.least(F.lit(WINDOW), b - a))
    covered = F.coalesce(F.aggregate(covers, F.lit(0), lambda total, n: total + n), F.lit(0))
    counted = marked.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": covered.cast("bigint"),
    })
    ratio = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    n_words, chars = F.col("n_words"), F.col("word_chars")
    ratios = {
        "repeat_ratio": ratio(F.col("n_repeat_words"), n_words),
        "symbol_ratio": ratio(F.col("n_symbols"), chars),
        "exclaim_ratio": ratio(F.col("_exclaims"), chars),
        "mean_word_chars": ratio(chars, n_words),
        "dup_line_ratio": ratio(F.col("n_dup_lines"), F.size("_lines")),
        "stop_ratio": F.when((F.col("_stops") < LEAST_STOPS * n_words) & _unknown(F.col("_body")), F.lit(None)).otherwise(
            ratio(F.col("_stops"), n_words)),
    }
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (*BASE, *ratios)]
    # Handed on through a generator of one row: a filter on a measure must not be pushed below it,
    # which would copy the measuring into the filter, once for each use.
    measures = F.struct(*[F.col(c) for c in BASE], *[r.alias(c) for c, r in ratios.items()])
    return counted.select(*others, F.inline(F.array(measures)))


def passes(rules: Sequence[Rule] = RULES) -> Column:
    """One boolean expression for a whole table of rules; a metric that is null breaks none."""
    verdict = F.lit(True)
    for rule in rules:
        held = F.lit(True)
        if rule.low is not None:
            held = held & (F.col(rule.metric) >= rule.low)
        if rule.high is not None:
            held = held & (F.col(rule.metric) <= rule.high)
        verdict = verdict & ((F.col("n_words") < rule.from_words) | F.coalesce(held, F.lit(True)))
    return verdict


def judge(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add all measures, ``base_failed`` (too short, or more than a fifth of the words recur in
    windows) and ``kept``: not ``base_failed`` and every rule holds. Null and empty texts fail.
    """
    n = F.col("n_words")
    failed = (n < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * n)
    measured = measure(docs, text).withColumn("base_failed", failed)
    return measured.withColumn("kept", ~F.col("base_failed") & passes(rules))


def good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that pass, with their own columns.

    The text is judged beside the row, so input columns named like a measure stay as they are.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return judge(docs.select(row, F.col(f"`{text}`").alias("_text")), "_text", rules).where("kept").select("_row.*")
