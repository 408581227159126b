"""Toxicity: held-out accuracy, windows and dictionaries against zstandard itself, odd rows."""

import random
import zlib

import numpy as np
import pytest
import zstandard

from civiclake.llm import toxicity
from civiclake.llm.queries import QUERIES

SYLLABLES = ["the", "on", "tion", "er", "re", "and", "qu", "is", "of", "lly"]


def prose(pick, n, bad=0.0):
    return " ".join(pick.choice(["grumblefish", "snarkwort"]) if pick.random() < bad else "".join(pick.choices(SYLLABLES, k=pick.randint(1, 3))) for _ in range(n))


def flat(text):
    return toxicity.flatten(np.frombuffer((text or "").encode(), np.uint8))


def test_query_on_held_out_documents(spark):
    made = {r.doc_id: r for r in QUERIES["op12_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    assert len(made) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in made.values())
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in made.items())
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if made[r.doc_id].held_out]
    bad, good = ([made[r.doc_id].predicted for r in labels if r.toxic == t] for t in (1, 0))
    assert sum(bad) >= 0.45 * len(bad) and sum(good) <= 0.02 * len(good)  # few toxic texts in the other languages to learn from
    english = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'en'").select("doc_id").collect()}
    bad = [made[r.doc_id].predicted for r in labels if r.toxic == 1 and r.doc_id in english]
    assert sum(bad) >= 0.85 * len(bad)


def test_flatten_and_windows():
    assert flat("It's\tFOO,  12 bär").tobytes().decode() == " it s foo bär " and toxicity.windows(flat(None)) == toxicity.windows(flat(" .!")) == []
    text = flat("word " * 200)
    cut = toxicity.windows(text)
    assert b"".join(w[: toxicity.WINDOW] for w in cut) == text.tobytes() and cut[0].endswith(cut[1][: toxicity.OVERLAP])


@pytest.fixture(scope="module")
def model():
    pick = random.Random(4)
    return toxicity.learn([flat(prose(pick, pick.randint(40, 300), 0.05)) for _ in range(60)], [flat(prose(pick, pick.randint(40, 300))) for _ in range(200)])


def test_differences_are_those_of_two_dictionaries(model):
    pick = random.Random(5)
    assert b"grumblefish" in model.toxic and b"grumblefish" not in model.ordinary and len(model.toxic) == len(model.ordinary)
    settings = zstandard.ZstdCompressionParameters(window_log=15, hash_log=14, chain_log=14, search_log=4, min_match=5, target_length=0, strategy=zstandard.STRATEGY_BTOPT,
                                                   write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    for bad in (0, 0.1):
        text = flat(prose(pick, 200, bad))
        sizes = []
        for held in (model.ordinary, model.toxic):
            own = zstandard.ZstdCompressionDict(held)
            packed = [zstandard.ZstdCompressor(dict_data=own, compression_params=settings).compress(w) for w in toxicity.windows(text)]
            opened = zstandard.ZstdDecompressor(dict_data=own, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            assert [opened.decompress(p, max_output_size=1000) for p in packed] == toxicity.windows(text)
            sizes.append([len(p) for p in packed])
        assert model.differences(text).tolist() == [a - b for a, b in zip(*sizes)]


def test_learnt_words_and_long_texts(model):
    pick = random.Random(6)
    assert all(model.score(flat(prose(pick, 150, 0.06))) >= 0.7 for _ in range(20)) and sum(model.score(flat(prose(pick, 150))) >= 0.7 for _ in range(50)) <= 1
    assert model.score(flat(prose(pick, 40_000, 0.05))) >= 0.7


def test_odd_rows(spark):
    pick = random.Random(7)
    docs = [(k, prose(pick, 120, 0.06 if k % 3 == 0 else 0), "z") for k in range(240)] + [(None, "some text", "z"), (300, None, "z"), (301, "", "z"), (1, prose(pick, 9), "z"), (1, prose(pick, 9), "z")]
    docs = spark.createDataFrame(docs, "doc_id long, text string, toxic string")
    labels = [(k, int(k % 3 == 0)) for k in range(240)] + [(0, 1), (5, None), (None, 1), (999, 1), (300, 0), (301, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    made = toxicity.score(docs, model)
    assert made.columns == ["doc_id", "text", "toxic", "score"] and made.count() == docs.count()
    scores = {r.doc_id: r.score for r in made.where("doc_id between 2 and 239").collect()}
    assert np.mean([(scores[k] >= 0.7) == (k % 3 == 0) for k in scores]) >= 0.97
    empty = {r.score for r in made.where("doc_id in (300, 301)").collect()}
    assert len(empty) == 1 and 0 <= empty.pop() < 0.7
    again = toxicity.train(docs.union(docs).repartition(5), labels.union(labels))
    assert (again.toxic, again.ordinary) == (model.toxic, model.ordinary) and np.allclose(again.weights, model.weights)
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, labels.limit(0))).collect()} == {0.0}
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs.limit(2), labels.where("toxic = 1"))).collect()} <= {0.0, 1.0}
    with pytest.raises(ValueError):
        toxicity.score(docs.withColumnRenamed("toxic", "Score"), model)
