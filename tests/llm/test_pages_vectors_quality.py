"""Url filter, WARC, nearest neighbours and the quality classifier."""

import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from civiclake.llm import annsearch, quality, urlfilter, warc
from civiclake.llm.common import shared_dir
from civiclake.llm.files import make_folder, open_file
from civiclake.llm.queries import ORACLES, QUERIES
from workload.check import compare, connect


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_url_filter_matches_duckdb(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert compare(QUERIES["op3_url_filter"](spark, folder), connect(folder), ORACLES["op3_url_filter"]) is None


URLS = {
    1: (None, "", "", None, "allow"), 2: ("no scheme.com/", "", "", None, "allow"), 3: ("http://EXAMPLE.com/en/x?y", "example.com", "/en/x", "example.com/en/", "block"),
    4: ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"), 5: ("http://a.net/es/#f", "a.net", "/es/", "net/es/", "block"),
    6: ("http://x.com", "x.com", "", None, "allow"), 7: ("http://x.com/a://b", "x.com", "/a://b", "com/", "allow"), 8: ("://h.org?p", "h.org", "", None, "allow"),
    9: ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), 10: ("http://ÄB.Org/P", "Äb.org", "/P", None, "allow"), 11: ("", "", "", None, "allow")}


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame([(k, u[0], "h") for k, u in URLS.items()] + [(None, "http://x.com/", "h")], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    made = {r.page_id: tuple(r[1:]) for r in urlfilter.filter_urls(pages, labels).collect()}
    assert made.pop(None) == ("x.com", "/", "com/", "allow")
    assert made == {k: u[1:] for k, u in URLS.items()}
    assert urlfilter.filter_urls(pages.limit(0), labels).count() == 0


def test_bad_hosts_are_blocked_and_shrunk(spark):
    rows = [(k, f"http://bad.evil.org/{k}") for k in range(40)] + [(100 + k, f"http://h{k}.good.org/") for k in range(60)] + [(200, "http://one.fair.org/"), (300, "http://new.evil.org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(k, 0, 0) for k in range(40)] + [(100 + k, 1, 0) for k in range(60)] + [(200, 0, 0), (200, None, None), (100, 1, 0)], "doc_id long, quality int, toxic int")
    verdicts = {r.page_id: r.verdict for r in urlfilter.filter_urls(pages, labels).collect()}
    assert {verdicts[k] for k in range(40)} == {"block"} and {verdicts[100 + k] for k in range(60)} == {"allow"}
    assert verdicts[200] == "allow"  # one bad page among good neighbours proves little
    assert verdicts[300] == "block"  # an unlabelled host of a bad domain inherits its posterior


def test_url_filter_is_native(spark):
    plan = QUERIES["op3_url_filter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


ODD_PAGES = [(1, "http://a b/é\n", "x"), (None, None, None), (2, "u", "x"), (2, "u", "x"), (2, "u", "other"), (3, "u", ""), (4, "u", None), (None, "q", "x"),
             (5, "v", "WARC/1.1 \r\n\r\nContent-Length: 3\r\n\r\n" * 900), (6, "v", "z" * 300_000), (-7, "v", "only")]


def archive(spark, rows, schema="page_id long, url string, html string", **more):
    folder = shared_dir(spark, "warc-test")
    make_folder(folder)
    warc.write(spark.createDataFrame(rows, schema).repartition(3), folder, **more).write.parquet(folder + "-index")
    return spark.read.schema("path string, bytes long").parquet(folder + "-index")


def test_warc_round_trip(spark):
    files = archive(spark, ODD_PAGES)
    first = {}
    for page_id, _, html in ODD_PAGES:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    for split in (700, 5000, 1 << 27):
        made = warc.read(files, split=split).collect()
        assert len(made) == len(ODD_PAGES)
        wanted = []
        for page_id, _, html in ODD_PAGES:
            raw = (html or "").encode()
            target = first.get(html or "")
            kind = "response" if page_id is None or page_id == target else "revisit"
            wanted.append((page_id, raw if kind == "response" else None, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, target if kind == "revisit" else None))
        assert sorted(map(repr, wanted)) == sorted(repr((r.page_id, None if r.payload is None else bytes(r.payload), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in made)


def test_warc_members_are_gzip_and_small_payloads_stay(spark):
    import gzip

    files = archive(spark, ODD_PAGES, least=2)
    assert {r.record_type for r in warc.read(files).where("payload_bytes < 2").collect()} == {"response"}
    for row in files.collect():
        with open_file(row.path) as file:
            assert gzip.decompress(file.read()).startswith(b"WARC/1.1\r\n")
    empty = archive(spark, [])
    assert warc.read(empty).count() == 0


def test_neighbours(spark):
    random = np.random.default_rng(3)
    vectors = random.standard_normal((900, 24)).astype(np.float32)
    vectors[5] = vectors[400]
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(vectors)]
    rows += [(2000, None, 1), (2100, [0.0] * 24, 1), (2200, [float("nan")] + [1.0] * 23, 1), (2300, [None] + [1.0] * 23, 1), (2400, [float("inf")] + [1.0] * 23, 1), (2500, [1.0], 1), (None, [1.0] * 24, 1)]
    rows += [(7, [float(x) for x in vectors[7]], 2)]  # a repeated row is a candidate of its own
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    made = annsearch.search(df, 10, 100).collect()
    every, ids = np.vstack([vectors, vectors[7:8]]).astype(float), np.append(np.arange(900), 7)
    found = 0
    assert {r.query_id for r in made} == set(range(0, 900, 100))
    for q in range(0, 900, 100):
        mine = sorted((r for r in made if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11)) and all(r.vec_id != q for r in mine)
        exact = np.sqrt(((every - every[q]) ** 2).sum(axis=1))
        assert all(abs(r.score - exact[r.vec_id]) < 1e-9 for r in mine)
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        best = [k for k in np.lexsort((ids, exact)) if ids[k] != q][:10]
        found += len({int(ids[k]) for k in best} & {r.vec_id for r in mine})
    assert found >= 0.9 * 90
    assert annsearch.search(df.limit(0)).count() == 0
    few = annsearch.search(df.where("vec_id in (0, 1, 2)"), 10, 100).orderBy("rank").collect()
    assert [r.rank for r in few] == [1, 2]


def test_neighbours_of_huge_and_tiny_vectors(spark):
    from fractions import Fraction

    random = np.random.default_rng(8)
    vectors = random.standard_normal((500, 12))
    vectors[3, 4], vectors[100], vectors[200, :], vectors[7] = 1e160, 1e-170 * random.standard_normal(12), -1.7e308, 1e-170 * random.standard_normal(12)
    made = annsearch.search(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>"), 10, 100).collect()
    assert len(made) == 50
    for q in range(0, 500, 100):
        scores = annsearch.distances(vectors, vectors[q])
        best = [k for k in np.lexsort((np.arange(500), scores)) if k != q][:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in made if r.query_id == q)
        assert len({k for _, k, _ in mine} & set(best)) >= 9 and all(s == scores[k] for _, k, s in mine)
    for a, b in ((3, 4), (7, 100), (7, 8), (3, 5)):
        exact = sum((Fraction(x) - Fraction(y)) ** 2 for x, y in zip(vectors[a].tolist(), vectors[b].tolist()))
        assert abs(Fraction(float(annsearch.distances(vectors[a: a + 1], vectors[b])[0])) ** 2 / exact - 1) < 1e-12


def test_bounds_hold():
    random = np.random.default_rng(1)
    data, query = random.standard_normal((4000, 64)), random.standard_normal((20, 64))
    mean, turn = data.mean(axis=0), annsearch.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    low, high = annsearch.bounds(*annsearch.encode(data, mean, turn), (query - mean) @ turn)
    exact = ((query[:, None] - data) ** 2).sum(axis=2)
    assert ((low <= exact) & (exact <= high)).mean() > 0.9


def crc(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 4


def test_quality(spark):
    made = {r.doc_id: r for r in QUERIES["op10_quality"](spark, "/root/testdata/sf0.1").collect()}
    assert len(made) == 10_000 and all(r.held_out == (crc(k) == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for k, r in made.items())
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if made[r.doc_id].held_out]
    assert sum(made[r.doc_id].predicted == r.quality for r in labels) >= 0.98 * len(labels)


def test_features_are_unit_vectors_and_local():
    texts = ["", "a", "a a a a", "x !! y", "é|é", "a b " * 50]
    raw = [t.encode() for t in texts]
    at = np.cumsum([0] + [len(r) for r in raw])
    text, slots, values = quality.features(np.frombuffer(b"".join(raw), np.uint8), at)
    assert np.allclose(np.bincount(text, values ** 2, len(texts)), [0, 1, 1, 1, 1, 1])
    for k, r in enumerate(raw):  # the same alone
        alone = quality.features(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert (alone[1] == slots[text == k]).all() and np.allclose(alone[2], values[text == k])


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "good words here", "c"), (3, "bad !! bad !!", "d"), (3, "bad !! bad !!", "d"), (4, "w " * 50_000, "e")], "doc_id long, text string, weights string")
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 0), (2, None), (None, 1), (4, 1), (99, 1)], "doc_id long, quality int")
    weights = quality.train(docs, labels)
    made = quality.score(docs, weights).collect()
    assert len(made) == 6 and all(0 <= r.score <= 1 for r in made) and made[0].score == made[1].score and "weights" in made[0].asDict()
    assert quality.score(docs.limit(0), weights).count() == 0
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}


def test_repeated_rows_and_labels_take_one_place_of_the_sample(spark):
    docs = [(k, f"alpha beta gamma {k}" if k % 2 else f"zeta eta theta {k}") for k in range(60)]
    labels = [(k, k % 2) for k in range(60)]
    frames = lambda d, m: (spark.createDataFrame(d, "doc_id long, text string"), spark.createDataFrame(m, "doc_id long, quality int"))
    first = spark.range(60).select("id").where(~quality.held_out(F.col("id"))).orderBy(F.xxhash64("id")).first()[0]
    plain = quality.train(*frames(docs, labels), sample=30)
    for d, m in ((docs + [docs[first]] * 40, labels), (docs, labels + [labels[first]] * 40)):
        assert np.array_equal(quality.train(*frames(d, m), sample=30), plain)
    scores = {r.doc_id: r.score for r in quality.score(frames(docs, labels)[0], plain).collect()}
    assert all((scores[k] > 0.5) == bool(q) for k, q in labels)
