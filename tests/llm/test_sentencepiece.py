import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arborsync.llm import sentencepiece_stream as s

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    return s.Encoder(s.read_model(PATH))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), dtype=np.int32).tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("aaeinrstthhe  ▁\n\r\té漢🙂();{}-=</s>"), max_size=80))
def test_ids_are_the_librarys_and_decode_back(encoder, library, text):
    assert ids(encoder, text) == library.encode(text)
    if s.SPACE not in text:
        assert s.decode(ids(encoder, text), encoder.model) == text


@pytest.mark.parametrize("text", ["a" * 3000, " " * 300 + "x", "=" * 700, "the" * 1500, "\n" * 200, "漢🙂" * 300, ""])
def test_long_runs(encoder, library, text):
    assert ids(encoder, text) == library.encode(text)


def test_window_stays_short(encoder, monkeypatch):
    """Ids come out while the text is still being read."""
    text = s.SPACE + "internationalization" * 400
    longest = 0
    shared = s.Encoder._shared

    def watch(self, size):
        nonlocal longest
        longest = max(longest, len(size))
        return shared(self, size)

    monkeypatch.setattr(s.Encoder, "_shared", watch)
    whole = list(encoder.stream(text))
    assert 0 < longest <= 8 * encoder.longest
    assert len(whole) > 400


def test_memo_starts_afresh(library, monkeypatch):
    monkeypatch.setattr(s, "MEMO_LIMIT", 3)
    encoder = s.Encoder(s.read_model(PATH))
    text = "some words that are not remembered for long, some words"
    assert ids(encoder, text) == library.encode(text)


def test_columns(spark, odd, library):
    tokenizer = s.Tokenizer(spark, PATH)
    done = s.encode(odd, PATH).withColumn("back", tokenizer.decode("ids"))
    rows = done.select("text", "ids", "back").collect()
    assert len(rows) == 12
    for r in rows:
        assert r["ids"] == library.encode(r["text"] or "") and r["back"] == (r["text"] or "")
    assert s.encode(odd.where("false"), PATH).count() == 0
    assert done.select(F.sum(F.size("ids"))).first()[0] > 0
