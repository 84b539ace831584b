import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arborsync.llm import token_counts as t

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    model = open(PATH, encoding="utf-8").read()
    return t.Counter(model, t.whole_tokens(model))


def test_proved_strings_are_single_tokens(counter):
    assert len(counter.proved) > 40_000
    strings = list(counter.proved)
    assert all(len(e.ids) == 1 for e in counter.tokenizer.encode_batch(strings, add_special_tokens=False))


@pytest.mark.parametrize("pattern, characters, step", [(t.LATIN_PRE_TOKEN, t.LATIN, 1), (t.PRE_TOKEN, t.AGREED, 31)])
def test_cuts_agree_with_the_library_on_every_character(counter, pattern, characters, step):
    agreed = t.regex.compile(f"[{characters}]")
    cut = counter.tokenizer.pre_tokenizer.pre_tokenize_str
    for code in range(0x11000):
        if (code > 0x600 and code % step) or 0xD800 <= code < 0xE000 or not agreed.match(chr(code)):
            continue
        c = chr(code)
        text = f"a{c}1{c}.{c} {c}'s'{c}"
        assert [o for _, o in cut(text)] == [m.span() for m in pattern.finditer(text)], hex(code)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'stré 漢͸​🙂19.,!\n\t <|endoftext|>"), max_size=60))
def test_count_is_the_librarys(counter, text):
    for own in (text, text + "<|endoftext|>" + text):
        assert counter.count(own) == counter.by_library(own)


def test_long_texts_are_cut_safely(counter):
    text = "It's the words' end.  \n\n  And 12 more" * 300
    assert "".join(t.chunks(text, 100)) == text
    assert sum(len(t.PRE_TOKEN.findall(c)) for c in t.chunks(text, 100)) == len(t.PRE_TOKEN.findall(text))
    assert counter.count("y" * 50_000) == counter.by_library("y" * 50_000)


def test_memo_starts_afresh(counter, monkeypatch):
    monkeypatch.setattr(t, "MEMO_LIMIT", 5)
    text = " ".join(f"zq{i}xw" for i in range(50))
    assert counter.count(text) == counter.by_library(text)


def test_odd_rows(odd):
    rows = {(r["doc_id"], r["text"]): r for r in t.count_tokens(odd, PATH).collect()}
    assert rows[0, None]["n_tokens"] == 0 and rows[1, ""]["n_bytes"] == 0
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows.values())


def test_empty_table(docs):
    assert t.count_tokens(docs([]), PATH).count() == 0
