"""The pipeline's stages on a small table."""

import random

import pytest

import corpus_pipeline

ITEM = "the benchmark asks how many apples fall from the old tree when seven winds shake it twice"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    english = "the and river stone house with morning light over water under green hills near old road people walk slowly home again".split()
    german = "der und Fluss Stein Haus mit Morgen Licht über Wasser unter grünen Hügeln nahe alter Straße Leute gehen langsam heim".split()
    rows = []
    for i in range(120):
        words = english if i % 2 else german
        rows.append((i, " ".join(rng.choice(words) for _ in range(60)), "en" if i % 2 else "de", "s", 0))
    rows += [
        (200, rows[1][1], "en", "s", 0),
        (201, rows[3][1] + " extra", None, "s", 0),
        (202, f"{rows[5][1]}\n{ITEM}", "en", "s", 0),
        (203, None, "en", "s", 0),
        (204, "12345 ...", "en", "s", 0),
        (205, rows[7][1] + "\n" + " ".join(rng.choice(english) for _ in range(70)), "en", "s", 0),
        (None, " ".join(rng.choice(english) for _ in range(60)), "en", "s", 0),
    ]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    ids = [{r["doc_id"] for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns, name
        ids.append({r["doc_id"] for r in docs.collect()})
    assert ids[0] - ids[1] == {203, 204}
    assert ids[1] == ids[2]
    assert ids[2] - ids[3]  # copies lose their lines and then go
    assert 202 not in ids[4] and None in ids[4]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r["doc_id"] for r in packed.collect()} == ids[4]


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
