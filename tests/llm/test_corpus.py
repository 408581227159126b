"""Near duplicates, repeated strings, benchmark leaks and the pipeline against brute-force versions."""

import collections
import hashlib
import pickle
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from civiclake.llm import decontaminate, ngramjoin, suffixdedup
from civiclake.llm.common import word_hashes
from civiclake.llm.components import components
from civiclake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SYLLABLES = ["the", "on", "tion", "zu", "é", "er", "re", "and", "qu", "x"]


def prose(pick, n):
    return " ".join("".join(pick.choices(SYLLABLES, k=pick.randint(1, 4))) for _ in range(n))


def shingles(text, width):
    words = _WORD.findall((text or "").encode().translate(_LOW))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k: k + width]) for k in range(len(words) - width + 1))


def brute_groups(rows, width=4, percent=85):
    """(size, smallest id of the group) of each row."""
    sets, parent, postings = [shingles(t, width) for _, t in rows], list(range(len(rows))), collections.defaultdict(list)

    def root(k):
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for k, own in enumerate(sets):
        common = collections.Counter(j for token in own for j in postings[token])
        for token in own:
            postings[token].append(k)
        for j, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                parent[root(k)] = root(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[root(k)] = min(doc_id, least.get(root(k), doc_id))
    return sorted((doc_id, len(sets[k]), least[root(k)]) for k, (doc_id, _) in enumerate(rows))


def edited(pick, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[pick.randrange(len(words))] = "".join(pick.choices(SYLLABLES, k=3)) + str(pick.randrange(1000))
    return " ".join(words)


def corpus(seed, copies=120):
    pick = random.Random(seed)
    base, line = prose(pick, 90), prose(pick, 12)
    rows = [prose(pick, pick.randint(1, 120)) for _ in range(60)] + [base] * 8 + [edited(pick, base, pick.randint(0, 5)) for _ in range(copies)]
    rows += [prose(pick, 10) + " " + line + " " + prose(pick, 10) for _ in range(50)] + ["", " \t\n", "a", "A", "b c d", "B  c\nd", "one two three four", "one two three four five", "w " * 3000]
    for n in (5, 6, 7, 8, 20, 40):  # sizes at the border of the threshold
        words = [f"{k}x" for k in range(n)]
        rows += [" ".join(words), " ".join(words + ["y"]), " ".join(words + ["y", "z"]), " ".join(["q"] + words)]
    pick.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width, percent, members, leaders", [(4, 85, 4096, 8), (4, 85, 16, 2), (5, 80, 16, 1), (1, 50, 10, 3)])
def test_ngram_join_matches_brute_force(spark, monkeypatch, width, percent, members, leaders):
    monkeypatch.setattr(ngramjoin, "MEMBERS", members)
    monkeypatch.setattr(ngramjoin, "LEADERS", leaders)
    rows = corpus(width)
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, n string").repartition(6)
    assert sorted(tuple(r) for r in ngramjoin.near_duplicates(df, width, percent).collect()) == brute_groups(rows, width, percent)


@pytest.mark.parametrize("members, crowd", [(4096, 32), (40, 2)])
def test_ngram_join_of_near_copies_that_do_not_link(spark, monkeypatch, members, crowd):
    """Sets too far from each other for a group share units, so a token of them all does not meet each with each."""
    pick = random.Random(4)
    base = [f"{k}x" for k in range(90)]
    rows = []
    for k in range(400):
        words = base.copy()
        for at in pick.sample(range(90), 4 if k % 8 else 1):
            words[at] += "abcdefgh"[pick.randrange(8)]
        rows.append((k, " ".join(words)))
    made = []
    opened = ngramjoin._opened

    def spy(kept, whole, units, *rest):
        here = kept.select("token", "sig").join(units, "sig").groupBy("token").agg(F.countDistinct("sig").alias("sets"), F.countDistinct("unit").alias("units"))
        made.append(here.agg(F.sum(F.col("sets") * F.col("units")), F.sum("sets")).first())
        return opened(kept, whole, units, *rest)

    monkeypatch.setattr(ngramjoin, "MEMBERS", members)
    monkeypatch.setattr(ngramjoin, "CROWD", crowd)
    monkeypatch.setattr(ngramjoin, "_opened", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted(tuple(r) for r in ngramjoin.near_duplicates(df).collect()) == brute_groups(rows)
    (pairs, held), = made
    assert pairs <= 8 * held or members < 400


def test_ngram_join_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op6_ngram_join"](spark, SF).collect()) == brute_groups(rows)


def test_ngram_join_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "p q r s t"), (3, "p q r s t"), (None, "p q r s t"), (None, None)], "doc_id long, text string")
    made = [tuple(r) for r in ngramjoin.near_duplicates(df).collect()]
    assert sorted(made, key=repr) == sorted([(1, 0, 1), (2, 0, 2), (3, 2, 3), (3, 2, 3), (None, 2, 3), (None, 0, None)], key=repr)
    assert ngramjoin.near_duplicates(df.limit(0)).count() == 0


def test_ngram_join_of_null_and_repeated_ids(spark):
    """Ids say nothing about texts: near copies under null ids and under one repeated id link like any others."""
    pick = random.Random(9)
    texts = [edited(pick, base, edits) for base in (prose(pick, 90) for _ in range(12)) for edits in (0, 1, 1, 2)] + [prose(pick, 40) for _ in range(8)]
    texts += texts[:4]
    expected = brute_groups(list(enumerate(texts)))
    for ids in ([None] * len(texts), [7] * len(texts), [None if k % 3 else 7 + k // 9 for k in range(len(texts))]):
        df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(5)
        names = collections.defaultdict(list)
        for k, _, group in expected:
            names[group].append(ids[k])
        least = {g: min((i for i in held if i is not None), default=None) for g, held in names.items()}
        wanted = [(ids[k], n, least[group]) for k, n, group in expected]
        assert sorted((tuple(r) for r in ngramjoin.near_duplicates(df).collect()), key=repr) == sorted(wanted, key=repr)


@pytest.mark.parametrize("percent", [50, 80, 85, 90, 99, 100])
def test_prefixes_are_long_enough(percent):
    """Sets that just link share the tokens that the prefixes promise, wherever their differences lie."""
    pick = random.Random(percent)
    for _ in range(3000):
        n, m = pick.randint(2, 60), pick.randint(2, 60)
        least = next((c for c in range(min(n, m) + 1) if 100 * c >= percent * (n + m - c)), None)
        if least is None or n == m == least:
            continue
        tokens = list(range(n + m - least))
        pick.shuffle(tokens)
        a, b = sorted(tokens[:n]), sorted(tokens[n - least: n - least + m])
        common = len(set(a[: ngramjoin.prefix(n, percent)]) & set(b[: ngramjoin.prefix(m, percent)]))
        assert common >= ngramjoin.shared(n, percent) and common >= ngramjoin.shared(m, percent)


def test_components(spark):
    pick = random.Random(5)
    links = [(k, k + 1) for k in range(300)] + [(1000 + pick.randrange(200), 1000 + pick.randrange(200)) for _ in range(120)] + [(7000, k) for k in range(5000, 5400)] + [(9, 9)]
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in links:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    made = {r.sig: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert made == {k: root(k) for k in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows, length=200):
    counts = collections.Counter()
    raw = [(t or "").encode() for _, t in rows]
    for r in raw:
        counts.update(r[k: k + length] for k in range(len(r) - length + 1))
    out = []
    for (doc_id, _), r in zip(rows, raw):
        gone = np.zeros(len(r) + 1, np.int64)
        for k in range(len(r) - length + 1):
            if counts[r[k: k + length]] > 1:
                gone[k] += 1
                gone[k + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        left = np.frombuffer(r, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(r), int(gone.sum()), int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def test_suffix_arrays():
    pick = random.Random(3)
    for _ in range(150):
        text = bytes(pick.choice(b"ab\xff") for _ in range(pick.randint(1, 200)))
        text = text[:17] * pick.randint(1, 9) if pick.random() < 0.4 else text
        order, rank = suffixdedup.suffix_array(np.frombuffer(text, np.uint8))
        assert order.tolist() == sorted(range(len(text)), key=lambda k: text[k:])
        shares = suffixdedup.common_prefixes(np.frombuffer(text, np.uint8), order, rank)
        for a, b in zip(order[1:].tolist(), order[:-1].tolist()):
            both = next((k for k in range(len(text)) if text[a + k: a + k + 1] != text[b + k: b + k + 1] or a + k >= len(text)), 0)
            assert shares[a] == both


@pytest.mark.parametrize("shard", [2 << 20, 3000])
def test_repeats_match_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(suffixdedup, "SHARD", shard)
    pick = random.Random(shard)
    passages = [prose(pick, 90) for _ in range(3)]
    texts = ["", None, "a" * 900, "ab" * 500, "abc" * 2000, "x" * 199, "x" * 200, "é" * 3000] + [
        prose(pick, pick.randint(0, 60)) + pick.choice(passages)[pick.randint(0, 60):] + prose(pick, pick.randint(0, 60)) for _ in range(40)]
    texts += texts[8:14]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, key int").repartition(5)
    assert sorted(tuple(r)[:5] for r in suffixdedup.digests(df).collect()) == brute_repeats(rows)
    cut = {r.doc_id: r for r in suffixdedup.drop_repeats(df).collect()}
    for doc_id, _, removed, _, sha in brute_repeats(rows):
        if not removed:
            assert cut[doc_id].text == texts[doc_id]
        elif "é" not in texts[doc_id]:
            assert hashlib.sha256(cut[doc_id].text.encode()).hexdigest() == sha
    assert cut[0].key == 1 and len(cut) == len(rows)


def test_repeats_query_and_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(tuple(r)[:5] for r in QUERIES["op2_suffix_dedup"](spark, SF).collect()) == brute_repeats(rows)
    long = "0123456789" * 3 + "".join(chr(97 + k % 23) + str(k) for k in range(200))
    df = spark.createDataFrame([(1, long), (1, long), (None, long), (None, None)], "doc_id long, text string")
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in suffixdedup.digests(df).collect()) == [(0, 0, 0)] + [(len(long), len(long), 1)] * 3
    assert suffixdedup.digests(df.limit(0)).count() == 0 and suffixdedup.drop_repeats(df.limit(0)).count() == 0


def best_distance(item, text):
    row = [0] * (len(text) + 1)
    for k, x in enumerate(item, 1):
        new = [k]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edit_distance():
    pick = random.Random(2)
    for _ in range(200):
        item, text = (bytes(pick.choices(b"abc", k=pick.randint(low, 70))) for low in (1, 0))
        assert decontaminate.distance(item, text) == best_distance(item, text)


def test_leaks(spark):
    pick = random.Random(6)
    items = [prose(pick, pick.randint(14, 40)) for _ in range(40)] + ["short one", "", None, "  ", "Ünïcode " + prose(pick, 20)]
    docs, wanted = [], set()
    for k, item in enumerate(items):
        if not item or not item.strip():
            continue
        for edits in (0, 1, 2):
            chars = list(item)
            for _ in range(edits if len(item) > 60 else 0):
                at = pick.randrange(len(chars))
                chars[at: at + 1] = pick.choice([[], ["#"], [chars[at], "%"]])
            wanted.add((len(docs), k))
            docs.append(prose(pick, 50) + " \n" + "".join(chars).upper().replace(" ", " \t") + "\n" + prose(pick, 30))
    clean = range(len(docs), len(docs) + 50)
    docs += [prose(pick, 100) for _ in clean] + [None, "", " "]
    df = spark.createDataFrame([(k, t, "z") for k, t in enumerate(docs)] + [(None, items[0], "z"), (0, docs[0], "z")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(k, t, 1) for k, t in enumerate(items)] + [(0, items[0], 1)], "item_id long, text string, doc_id int")
    made = decontaminate.leaks(df, bench).collect()
    found = {(r.doc_id, r.item_id) for r in made if r.doc_id is not None}
    assert len(found & wanted) >= 0.95 * len(wanted)
    norm = lambda t: re.sub(rb"[\x20\x09-\x0D]+", b" ", t.encode().translate(_LOW)).strip()
    for r in made[:60]:
        item, text = norm(items[r.item_id]), norm(items[0] if r.doc_id is None else docs[r.doc_id])
        assert best_distance(item, text) <= r.distance <= 0.1 * len(item)
    assert (None, 0) in {(r.doc_id, r.item_id) for r in made}
    kept = {r.doc_id for r in decontaminate.without_leaks(df, bench).collect()}
    assert kept == set(range(len(docs))) - {d for d, _ in found} and set(clean) <= kept
    assert decontaminate.without_leaks(df, bench).columns == df.columns
    assert decontaminate.leaks(df, bench.limit(0)).count() == 0 and decontaminate.leaks(df.limit(0), bench).count() == 0


def spread(pick, item, edits, even):
    chars = list(item)
    places = [int((k + 0.5) * len(chars) / edits) for k in range(edits)] if even else sorted(pick.sample(range(len(chars)), edits))
    for at in reversed(places):
        chars[at: at + 1] = pick.choice([["#"], [], [chars[at], "#"], ["e"]])
    return "".join(chars)


def flat(text):
    return text.encode().translate(_LOW)


def test_leaks_are_those_within_the_bound(spark, monkeypatch):
    """Evenly spaced and random edits up to the bound, on long and short items: the pairs of a brute-force search."""
    pick = random.Random(8)
    items = [prose(pick, 60)[:n].strip() + "." for n in (9, 10, 19, 20, 25, 29, 30, 40, 59, 95, 150, 233, 300)] + ["ab" * 30, "a", "ab", "x" * 150]
    texts = ["", "zu", "x" * 400]
    for item in items:
        most = len(flat(item)) // 10
        for edits in {0, most // 2, most, most + 1}:
            for even in (True, False):
                if edits <= len(item):
                    texts.append(" ".join((prose(pick, pick.randint(0, 9)) + spread(pick, item, edits, even) + prose(pick, pick.randint(0, 9))).split()))
    wanted = {(t, i): best_distance(flat(item), flat(text)) for t, text in enumerate(texts) for i, item in enumerate(items)}
    wanted = {pair: d for pair, d in wanted.items() if d <= len(flat(items[pair[1]])) // 10}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = decontaminate.leaks(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    block, at = np.frombuffer("".join(texts).encode().translate(_LOW), np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)])
    monkeypatch.setattr(decontaminate, "FINDS", 50)  # compared in many steps
    held = decontaminate.Items(list(range(len(items))), [flat(i) for i in items])
    found = {(r.doc_id, r.item_id): r.distance for r in made}
    assert {(t, i): d for t, i, d, _ in held.matches(block, at)} == found and len(made) == len(found)
    assert set(found) <= set(wanted) and len(found) >= 0.98 * len(wanted) and all(found[p] >= wanted[p] for p in found)
    assert sum(found[p] == wanted[p] for p in found) >= 0.98 * len(found)
    for r in made:
        item, text = flat(items[r.item_id]), flat(texts[r.doc_id])[r.start:]
        assert min(best_distance(item, text[:n]) for n in range(len(item) + r.distance + 1)) == r.distance


@pytest.mark.parametrize("even", [True, False])
@pytest.mark.parametrize("share", [0.05, 0.08, 0.1])
def test_recall(share, even):
    """Candidates come from the buckets; the share of the planted pairs that they bring is the stated one."""
    pick = random.Random(int(100 * share) + even)
    items = [flat(prose(pick, 120)[:n]) for n in [*range(82, 394, 4)] * 2 + [*range(20, 82, 3)]]
    held = decontaminate.Items(list(range(len(items))), items)
    texts = [flat(prose(pick, pick.randint(1, 30))) + b" " + spread(pick, item.decode(), int(share * len(item)), even).encode() + flat(prose(pick, pick.randint(1, 30))) for item in items]
    at = np.cumsum([0, *map(len, texts)])
    block = np.frombuffer(b"".join(texts), np.uint8)
    texts_of, items_of, _ = held.bands(block, at)
    candidates, found = set(zip(texts_of.tolist(), items_of.tolist())), {(t, i) for t, i, *_ in held.matches(block, at)}
    wanted = {(k, k) for k, item in enumerate(items) if decontaminate.distance(item, texts[k]) <= len(item) // 10}
    assert len(wanted) >= 90 and found <= candidates and len(found & wanted) >= max(decontaminate.RECALL, 0.97) * len(wanted)


def test_walks_come_together_again():
    """One edit leaves most steps of a walk as they are; unlike texts share few."""
    pick = random.Random(1)
    same, other = [], []
    for k in range(200):
        a, b = flat(prose(pick, 60)[:100]), flat(prose(pick, 60)[:100])
        c = spread(pick, a.decode(), 2, False).encode()
        x, y, z = (decontaminate.embed(np.frombuffer(t + bytes(100), np.uint8), np.array([0]), k % 3, 100) for t in (a, c, b))
        same.append((x == y).mean())
        other.append((x == z).mean())
    assert np.mean(same) > 0.75 and np.mean(other) < 0.25
    assert (decontaminate.coins(0, 50) != decontaminate.coins(1, 50)).mean() > 0.4


def test_a_very_long_item_takes_memory_by_its_bytes():
    pick = random.Random(4)
    item = bytes(pick.choices(b"abcdefgh ", k=100_000)).replace(b"  ", b"x ")
    held = decontaminate.Items([1], [item])
    assert len(pickle.dumps(held)) < 100 * len(item)
    copy = bytearray(item)
    for place in range(10, len(item), 20):  # 5 % edits at even distances
        copy[place] = 35
    text = np.frombuffer(b"zz " + bytes(copy) + b" zz", np.uint8)
    assert [m[:3] for m in held.matches(text, np.array([0, len(text)]))] == [(0, 0, len(range(10, len(item), 20)))]


def test_a_large_benchmark_is_read_in_passes(spark, monkeypatch):
    pick = random.Random(11)
    items = [prose(pick, 20) for _ in range(30)]
    docs = spark.createDataFrame([(k, f"zz {t} yy" if k % 2 else prose(pick, 60)) for k, t in enumerate(items)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 700)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == {(k, k) for k in range(1, 30, 2)}
    assert {r.doc_id for r in decontaminate.without_leaks(docs, bench).collect()} == set(range(0, 30, 2))


def test_leaks_query_finds_every_exact_passage(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    flat = lambda t: " ".join(t.lower().split())
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if flat(x) in flat(t)}
    assert exact and exact <= {(r.doc_id, r.item_id) for r in QUERIES["op4_decontaminate"](spark, SF).collect()}


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near duplicates", "repeated passages", "benchmark leaks", "token ids"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        steps.append({r.doc_id: r for r in docs.collect()})
    before = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(list(r.asDict()) == columns for step in steps[:4] for r in list(step.values())[:1])
    good, single, cut, clean, last = steps
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(k in good for k, q in labels.items() if q == 1) and set(good) <= set(before)
    groups = collections.defaultdict(set)
    for doc_id, n, group in brute_groups([(k, r.text) for k, r in good.items()], 5, 80):
        groups[group if n else ("none", doc_id)].add(doc_id)
    assert all(len(g & set(single)) == 1 for g in groups.values()) and len(single) == len(groups)
    repeats = {k: sha for k, *_, sha in brute_repeats([(k, r.text) for k, r in single.items()])}
    assert {k: hashlib.sha256(r.text.encode()).hexdigest() for k, r in cut.items()} == repeats and all(r.n_chars == len(r.text) for r in cut.values())
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {k for k, r in cut.items() if any(i in " ".join(r.text.lower().split()) for i in items)}
    assert set(clean) <= set(cut) - dirty and set(last) == set(clean)


@pytest.fixture(scope="module")
def thue_morse():
    """Two strings of the letters a and b that a polynomial modulo 2^64 does not tell apart."""
    first = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    return first, first.translate(str.maketrans("ab", "ba"))


def test_unlike_words_do_not_collide(spark, thue_morse):
    df = spark.createDataFrame([(1, thue_morse[0]), (2, thue_morse[1]), (3, thue_morse[0].upper())], "doc_id long, text string")
    assert sorted(tuple(r) for r in ngramjoin.near_duplicates(df).collect()) == [(1, 1, 1), (2, 1, 2), (3, 1, 1)]
    raw = "".join(thue_morse).encode()
    data, at = np.frombuffer(raw, np.uint8), np.array([0, 1024, 2048])
    assert len(np.unique(suffixdedup._digests(data, at[:-1], at[1:]))) == 2


def test_word_hashes_are_those_of_words_alone():
    pick = random.Random(12)
    words = ["".join(pick.choices("abAB\u00e9", k=n)) for n in range(1, 40) for _ in range(5)]
    text = " ".join(words).encode()
    hashes = word_hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    lowered = [w.encode().translate(_LOW) for w in words]
    alone = [int(word_hashes(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][0]) for w in lowered]
    assert hashes.tolist() == alone and len(set(alone)) == len(set(lowered))


@pytest.mark.parametrize("name", ["score", "__score", "__key", "__size", "__group", "__n", "__row", "__spans", "row", "tokens", "item_id"])
def test_pipeline_keeps_clashing_columns(spark, name):
    import corpus_pipeline

    pick = random.Random(13)
    texts = [prose(pick, 60) for _ in range(6)]
    docs = spark.createDataFrame([(k, t, -5.0 - k) for k, t in enumerate([*texts, texts[0], ""])], f"doc_id long, text string, {name} double")
    for step, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        made = stage(spark, docs, SF)
        assert made.columns == docs.columns and all(r[2] == -5.0 - r.doc_id for r in made.collect()), step


def test_pipeline_of_odd_rows(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, None, "en", "s", 0), (None, "", None, None, None), (2, "a b c d e f", "en", "s", 11), (2, "a b c d e f", "en", "s", 11), (3, "x " * 20_000, "en", "s", 40_000)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        for given in (docs, docs.limit(0)):
            made = stage(spark, given, SF)
            assert made.count() <= given.count()
            assert k == 4 or made.columns == docs.columns
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 2, 3]
