import random

import pytest

from arborsync.operators import masking


def model(text, secrets):
    for s in sorted({s for s in secrets if s}, key=lambda s: (-len(s), s)):
        text = text.replace(s, "***")
    return text


@pytest.mark.parametrize("block_bytes", [1, 40, 8 << 20])
def test_equals_replacing_in_turn(spark, block_bytes):
    rng = random.Random(block_bytes)
    secrets = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(12)] + ["", "aXb", "aXbX"]
    texts = ["".join(rng.choice("abéX ") for _ in range(rng.randint(0, 80))) for _ in range(60)] + ["", "aXbXaXb", None]
    rows = spark.createDataFrame([(i, t, "kept a") for i, t in enumerate(texts)], "id int, text string, other string")
    table = spark.createDataFrame([(s,) for s in secrets + secrets[:3] + [None]], "secret string")
    if block_bytes == 1:
        table = table.where("length(secret) > 4 or secret in ('aXb', '')")
        secrets = [s for s in secrets if len(s) > 4 or s in ("aXb", "")]
    got = {r["id"]: (r["text"], r["other"]) for r in masking.mask_secret_table(rows, "text", table, block_bytes=block_bytes).collect()}
    assert got == {i: (None if t is None else model(t, secrets), "kept a") for i, t in enumerate(texts)}


def test_many_secrets_in_one_pass(spark):
    table = spark.range(100_000).selectExpr("concat('key-', id, '-', sha1(cast(id as string))) as secret")
    rows = table.limit(50).selectExpr("concat('before ', secret, ' after ', secret) as text")
    assert {r["text"] for r in masking.mask_secret_table(rows, "text", table).collect()} == {"before *** after ***"}
    assert masking.mask_secret_table(rows, "text", table.where("false")).count() == 50


def test_equal_stretches_are_masked_once_and_any_character_may_end_one(monkeypatch):
    hidden = []
    plain = masking.Masker.hide
    monkeypatch.setattr(masking.Masker, "hide", lambda self, text: hidden.append(text) or plain(self, text))
    masker = masking.Masker(["words", "or", "a"])
    assert masker.mask("swords or, swords and words: or") == "s*** ***, s*** ***nd ***: ***"
    assert [masker.mask("swords or swords")] * 100 == [masker.mask("swords or swords") for _ in range(100)]
    assert sorted(hidden) == sorted(["swords", "or", "a", "d", "words"])

    monkeypatch.setattr(masking, "STRETCHES", 3)
    rng = random.Random(9)
    for letters in ("^-]a", "\\[&~é", "*|a\n", "--b 😀"):
        secrets = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(8)}, key=lambda s: (-len(s), s))
        masker = masking.Masker(secrets)
        for _ in range(200):
            text = "".join(rng.choice(letters + "xy") for _ in range(rng.randint(0, 150)))
            # A mark no secret holds, as the mask's own stars are no part of a match.
            expected = text
            for secret in secrets:
                expected = expected.replace(secret, "\0")
            assert masker.mask(text) == expected.replace("\0", masking.MASK)
        assert len(masker) <= 3
