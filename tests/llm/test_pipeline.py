"""The pipeline, stage by stage, on documents with planted cases, and whole."""

import random

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece


@pytest.fixture(scope="module")
def folder(spark, prose, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    bench = prose(700, 30)
    passage = prose(701, 60).replace("\n", " ")
    draw = random.Random(3)
    near = prose(20, 200).split(" ")
    near[draw.randrange(50)] = "changed"
    rows = [(i, prose(i, 150)) for i in range(12)]
    rows += [(20, prose(20, 200)), (21, prose(20, 200)), (22, " ".join(near))]
    rows += [(30 + i, prose(30 + i, 100) + "\n" + passage) for i in range(4)]
    rows += [(40, prose(40, 90) + "\n" + bench + "\n" + prose(41, 90)), (41, bench)]
    rows += [(50, None), (51, ""), (52, "buy now " * 60), (53, prose(53, 5)), (54, "é漢🙂 " + prose(54, 100))]
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, bench), (2, "unrelated words stand here")], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, prose):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names[0] == "quality rules" and len(names) == 5
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, folder)
        seen.append({r["doc_id"]: r for r in docs.collect()})
        if len(seen) < 5:
            assert docs.columns == columns
            assert all(r["n_chars"] == len(r["text"]) for r in seen[-1].values())
    quality, lines, near, decontaminated, encoded = seen
    clean = set(range(12)) | {54}
    assert set(quality) == clean | {20, 21, 22, 30, 31, 32, 33, 40, 41}
    passage = prose(701, 60).replace("\n", " ")
    assert [i for i, r in lines.items() if passage in r["text"]] == [30]
    assert set(near) == set(lines) - {21, 22}
    assert set(decontaminated) == set(near) - {41}
    assert decontaminated[40]["text"].startswith(prose(40, 90)) and decontaminated[40]["text"].endswith(prose(41, 90))
    assert prose(700, 30).split()[5] not in decontaminated[40]["text"].split()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {i: r["ids"] for i, r in encoded.items()} == {i: library.encode(r["text"]) for i, r in decontaminated.items()}
    for i in clean:
        assert library.decode(encoded[i]["ids"]) == (prose(i, 150) if i < 12 else "é漢🙂 " + prose(54, 100))
    whole = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert whole == {i: r["ids"] for i, r in encoded.items()}


def test_empty_table_and_extra_columns(spark, folder):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({"key": F.lit(1), "label": F.lit("x"), "line": F.lit(2)})
    for start in (docs.where("false"), docs.where("doc_id < 3")):
        rows = start
        for _, function in corpus_pipeline.STAGES[:-1]:
            rows = function(spark, rows, folder)
            assert rows.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, rows, folder).count() == start.count()
