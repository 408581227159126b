"""Phrase collocations against DuckDB and against plain counting."""

import collections
import random
import re

import numpy as np
import pytest

from civiclake.llm import phrases
from civiclake.llm.queries import ORACLES, QUERIES
from workload.check import compare, connect

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, best):
    counts, sizes = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(len(words)):
                for n in range(1, 6):
                    if k + n <= len(words):
                        counts[lang][tuple(words[k: k + n])] += 1
    out = []
    for lang, known in counts.items():
        often = {p: a for p, a in known.items() if a >= least and len(p) > 1}
        rows = []
        for p, a in often.items():
            if any(len(q) > len(p) and b >= a and any(q[k: k + len(p)] == p for k in range(len(q))) for q, b in often.items()):
                continue
            score, _, left, right = min((1000 * a * sizes[lang] // (known[p[:k]] * known[p[k:]]), k, known[p[:k]], known[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k + 1, p.decode(), -a, left, right, sizes[lang], -score) for k, (score, a, p, left, right) in enumerate(sorted(rows)[:best])]
    return sorted(out)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_duckdb(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert compare(QUERIES["op11_phrases"](spark, folder), connect(folder), ORACLES["op11_phrases"]) is None


def odd_rows(seed):
    pick = random.Random(seed)
    words = ["the", "of", "The", "ünï", "Ü", "a|b", "x y", "new", "york", "1", "日本", "-"]
    rows = []
    for k in range(150):
        out = "".join(pick.choice(words) + pick.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "?!", "\r", "\v"]) for _ in range(pick.randint(0, 60)))
        rows.append((pick.choice(["en", None, "und", "fr"]), out + pick.choice(["new york city council", " the the the the the the ", ""])))
    return rows + [("en", None), (None, ""), ("en", " \t"), ("fr", "new york " * 3000), ("zz", "new york. " * 20)] + [("en", "new york city council of the")] * 30


@pytest.mark.parametrize("chunk, suffixes, words", [(2 << 20, 1 << 20, 2_000_000), (64, 40, 300)])
def test_odd_rows(spark, monkeypatch, chunk, suffixes, words):
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    monkeypatch.setattr(phrases, "SUFFIXES", suffixes)
    monkeypatch.setattr(phrases, "ROUTE_WORDS", words)
    rows = odd_rows(chunk)
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "lang string, text string, a int, phrase string").repartition(6)
    for least, best in ((12, 2000), (3, 7)):
        assert sorted(map(tuple, phrases.collocations(df, least, best).collect())) == brute(rows, least, best)
    assert phrases.collocations(df.limit(0)).count() == 0


def test_full_tables_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PAIR_BITS", 3)  # every slot is frequent
    monkeypatch.setattr(phrases, "WORD_BITS", 3)
    monkeypatch.setattr(phrases, "PART", 8)
    rows = odd_rows(5)
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(2)
    assert sorted(map(tuple, phrases.collocations(df, 9, 500).collect())) == brute(rows, 9, 500)


def test_quicksort_counts_prefixes():
    random = np.random.default_rng(3)
    for _ in range(60):
        sizes = random.integers(2, 6, 80)
        suffixes = np.where(np.arange(5) < sizes[:, None], random.integers(1, 4, (80, 5)), 0).astype(np.int32)
        weights = random.integers(1, 9, 80)
        wanted = collections.Counter()
        for row, size, weight in zip(suffixes.tolist(), sizes, weights.tolist()):
            for n in range(2, size + 1):
                wanted[tuple(row[:n])] += weight
        made = {tuple(suffixes[k, :n].tolist()): count for k, n, count in phrases.quicksort(suffixes, weights, 20)}
        assert made == {p: c for p, c in wanted.items() if len(p) < 3 or c >= 20}


def test_large_products_are_exact(spark):
    n = 30_000_000_000_000_000
    counts = spark.createDataFrame([("x", "p q", 29_999_999_999_999_999), ("x", "p", n), ("x", "q", n)], "lang string, phrase string, a long")
    sizes = spark.createDataFrame([("x", n)], "lang string, n long")
    phrases_of = phrases.phrase_counts
    try:
        phrases.phrase_counts = lambda docs, least: (counts, sizes)
        row = phrases.collocations(spark.createDataFrame([], "lang string, text string")).first()
    finally:
        phrases.phrase_counts = phrases_of
    assert row.score == 1000 * 29_999_999_999_999_999 * n // (n * n) == 999


def test_packed_words_add_up():
    counts = [collections.Counter({b"a": 3, "é".encode(): 70000, b"\x00": 1}), collections.Counter({b"a": 2}), collections.Counter()]
    for routes in (1, 7):
        blobs = {}
        for some in counts:
            for route, packed in phrases.packed_words(some, routes):
                blobs.setdefault(route, []).append(packed)
        assert sum((phrases.added_words(b) for b in blobs.values()), collections.Counter()) == sum(counts, collections.Counter())
        assert sum(len(phrases.added_words(b)) for b in blobs.values()) == 3  # a word has one route
    assert phrases.added_words([]) == collections.Counter()
