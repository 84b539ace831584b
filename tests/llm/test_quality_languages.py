"""Clean texts that the four languages of the stop words do not cover, and capitals."""

import random

from arborsync.llm import quality_rules


def written(letters, words, seed, of=()):
    draw = random.Random(seed)
    return "\n".join(" ".join(
        draw.choice(of) if of and k % 4 == 0 else "".join(draw.choice(letters) for _ in range(draw.randint(2, 9))) for k in range(12)
    ) for _ in range(words // 12))


def test_clean_texts_of_other_scripts_and_in_capitals(docs, prose):
    russian, greek = "абвгдежзийклмнопрстуфхцчшщыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"
    arabic, korean = "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "가나다라마바사아자차카타파하고노도로모보소오조"
    clean = [written(s, 240, i) for i, s in enumerate((russian, greek, arabic, korean))]
    clean += [prose(5, 240).upper(), prose(6, 240), written("abcdefgz", 240, 7, ("yang", "dan", "untuk")), written("aąeęłkoszżn", 240, 8)]
    junk = [written("bcdfgz", 240, 9), written("bcdfgz", 240, 10).upper(), written("0123456789", 240, 11)]
    judged = {r["doc_id"]: r for r in quality_rules.judge(docs(clean + junk)).collect()}
    assert [judged[i]["kept"] for i in range(len(clean + junk))] == [True] * len(clean) + [False] * len(junk)
    assert judged[0]["stop_ratio"] is None and judged[4]["stop_ratio"] == judged[4]["stop_ratio"] > 0.2
