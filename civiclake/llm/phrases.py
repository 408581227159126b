"""Phrase collocations: frequent phrases by multikey three-way quicksort of suffix pointers.

1. A pass over the texts adds up hashed counts of words and of neighbouring words in tables of fixed size. A slot
   below the threshold proves that none of its words or pairs is frequent; the rest are kept as two bit maps.
2. A second pass follows, from every word, the pairs that may be frequent, to at most LONGEST words. These suffixes
   are counted where they are equal, and routed by the hash of their language and two leading words and one of SPLIT
   classes of the third, so that a frequent leading pair is dealt over several tasks. Single words are counted alongside
   and routed by their own hash, in a row per task, language and route as the suffixes are.
3. Each route sorts its suffixes by multikey three-way quicksort: the weight of an equal partition is the count of the
   phrase it stands for; partitions below the threshold are abandoned. A phrase shorter than the routing words is
   counted in part by several routes, never abandoned there, and added up.
4. Scores, the lowest cut, containment in longer phrases and the ranks are joins and aggregations of the frequent
   phrases; products are exact decimals.

Contract: A-Z are lower-cased; pieces end at ``[.,;:!?\\x0A-\\x0D]`` and words are ``[^\\x20\\x09]+`` in them. Null
texts are empty, a null lang is ``und``. Repeated rows and rows with the same or no id count each. Texts are read
whole, a long one in runs of pieces, of which one alone is never divided. Equal scores go to the larger count, then
to the smaller phrase in UTF-8 order. An empty table has no phrases. Columns beyond lang and text are ignored. Counts
are exact for a * n below 10^35.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclake.llm.common import materialise, mix, small_batches, table, word_hashes

#: Words of the longest phrase, leading words that route a suffix, and routes over which the third deals a leading pair.
LONGEST, ROUTED, SPLIT = 5, 3, 4
#: Occurrences of a phrase, at least; phrases of each lang that are returned.
LEAST, BEST = 100, 2000
#: Bits of the hashed counts of pairs and of single words, and slots of a part of these tables.
PAIR_BITS, WORD_BITS, PART = 24, 22, 1 << 18
#: Bytes that are split into words at once, and suffixes that are counted at once.
CHUNK, SUFFIXES = 2 << 20, 1 << 20
#: Words of the corpus for each route.
ROUTE_WORDS = 2_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(10, 14)]] = True
_INSIDE = ~_ENDS
_INSIDE[[32, 9]] = False
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(lang.encode()[:64].ljust(8, b"\1"), "big") % (1 << 61))


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, np.ndarray]]:
    """(lang, lower-case bytes) of runs of whole pieces of about ``size`` bytes; texts are parted by a line feed."""
    for batch in batches:
        langs = pc.fill_null(batch.column("lang"), "und")
        for lang in langs.unique().to_pylist():
            texts = pc.fill_null(batch.column("text").filter(pc.equal(langs, lang)), "").to_pylist()
            data = _LOWER[np.frombuffer("\n".join(texts).encode(), np.uint8)]
            start = 0
            while start < len(data):
                stop = start + size
                if stop < len(data):
                    rest = _ENDS[data[stop:]]
                    stop += int(rest.argmax()) + 1 if rest.any() else len(rest)
                yield lang, data[start:stop]
                start = stop


class Words:
    """Words of a chunk: hashes, places, and whether the next word follows in the same piece."""

    def __init__(self, lang: str, data: np.ndarray):
        self.data = data
        hashes, self.first, self.last, _ = word_hashes(data, np.array([0, len(data)]), np.arange(256, dtype=np.uint8), _INSIDE)
        self.hashes = hashes + _seed(lang)
        ends = np.cumsum(_ENDS[data])
        self.joined = ends[self.last[:-1] - 1] == ends[self.first[1:]] if len(hashes) else np.zeros(0, bool)

    def pairs(self, bits: int) -> np.ndarray:
        """Slot of every word and its successor, whether they are joined or not."""
        return (mix(self.hashes[:-1] * _STEP + self.hashes[1:]) >> np.uint64(64 - bits)).astype(np.int64)

    def words(self, bits: int, behind: int) -> np.ndarray:
        """Slot of every word, in a table that lies behind that of the pairs."""
        return (mix(self.hashes) >> np.uint64(64 - bits)).astype(np.int64) + (1 << behind)


def hashed_counts(docs: DataFrame, least: int) -> DataFrame:
    """Per task: (part, counts) of the parts of both tables, each count at most ``least`` and 255, and (lang, n)."""
    top, pair_bits, word_bits, part_size, chunk = min(least, 255), PAIR_BITS, WORD_BITS, PART, CHUNK
    size = (1 << pair_bits) + (1 << word_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, held = np.zeros(size, np.uint8), [], 0
        totals: Counter[str] = Counter()

        def add() -> None:
            nonlocal held
            slots, more = np.unique(np.concatenate(waiting), return_counts=True)
            counts[slots] = np.minimum(counts[slots] + np.minimum(more, top), top)
            waiting.clear()
            held = 0

        for lang, data in chunks(batches, chunk):
            words = Words(lang, data)
            totals[lang] += len(words.hashes)
            waiting += [words.pairs(pair_bits)[words.joined], words.words(word_bits, pair_bits)]
            held += len(words.hashes)
            if held >= SUFFIXES:
                add()
        if waiting:
            add()
        if totals:
            yield pa.RecordBatch.from_pydict({"part": pa.array([None] * len(totals), pa.int32()), "counts": pa.array([None] * len(totals), pa.binary()),
                                              "lang": pa.array(list(totals), pa.string()), "n": pa.array(list(totals.values()), pa.int64())})
        pack = zstandard.ZstdCompressor(1).compress
        for part in range(size // part_size):
            own = counts[part * part_size: (part + 1) * part_size]
            if own.any():
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "counts": pa.array([pack(own.tobytes())], pa.binary()),
                                                  "lang": pa.array([None], pa.string()), "n": pa.array([None], pa.int64())})

    return docs.mapInArrow(run, "part int, counts binary, lang string, n long")


def frequent_slots(counted: DataFrame, least: int) -> np.ndarray:
    """Bits of the slots whose counts reach ``least``, or 255; their number is fixed."""
    top, part_size = min(least, 255), PART

    def total(group: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(part_size, np.int64)
        for packed in group["counts"]:
            counts += np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
        return pd.DataFrame({"part": [group["part"].iloc[0]], "bits": [np.packbits(counts >= top).tobytes()]})

    bits = np.zeros(((1 << PAIR_BITS) + (1 << WORD_BITS)) // 8, np.uint8)
    for row in counted.where("part is not null").groupBy("part").applyInPandas(total, "part int, bits binary").collect():
        bits[row["part"] * PART // 8: (row["part"] + 1) * PART // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _set(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8) & 1).astype(bool)


class Suffixes:
    """Suffixes of one language that wait to be counted and routed."""

    def __init__(self, lang: str):
        self.lang = lang
        self.vocabulary: dict[bytes, int] = {}
        self.hashes: list[int] = [0]
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: Words, pairs: np.ndarray) -> None:
        """The suffixes of a chunk, whose ``pairs`` tell which words may go on."""
        follows = words.joined & pairs
        if not follows.any():
            return
        member = np.zeros(len(words.hashes), bool)
        member[:-1] |= follows
        member[1:] |= follows
        places = np.flatnonzero(member)
        raw, known = words.data.tobytes(), self.vocabulary
        ids = np.zeros(len(words.hashes) + LONGEST, np.int32)
        hashes = words.hashes[places].tolist()
        own = []
        for a, b, h in zip(words.first[places].tolist(), words.last[places].tolist(), hashes):
            word = raw[a:b]
            k = known.get(word)
            if k is None:
                k = known[word] = len(known) + 1
                self.hashes.append(h)
            own.append(k)
        ids[places] = own
        starts = np.flatnonzero(follows)
        suffixes = np.zeros((len(starts), LONGEST), np.int32)
        going = np.ones(len(starts), bool)
        padded = np.concatenate([follows, np.zeros(LONGEST, bool)])
        suffixes[:, 0] = ids[starts]
        for k in range(1, LONGEST):
            going &= padded[starts + k - 1]
            suffixes[going, k] = ids[starts[going] + k]
        self.parts.append(suffixes)
        self.size += len(suffixes)

    def routed(self, routes: int) -> Iterator[tuple[str, int, bytes]]:
        """(lang, route, packed suffixes with their counts)."""
        suffixes = np.concatenate(self.parts)
        order = np.lexsort(suffixes.T[::-1])
        suffixes = suffixes[order]
        first = np.flatnonzero(np.concatenate([[True], (suffixes[1:] != suffixes[:-1]).any(axis=1)]))
        weights, suffixes = np.diff(np.append(first, len(suffixes))), suffixes[first]
        hashes = np.array(self.hashes, np.uint64)
        pair = mix(hashes[suffixes[:, 0]] * _STEP + hashes[suffixes[:, 1]])
        third = mix(pair * _STEP + hashes[suffixes[:, 2]]) % np.uint64(SPLIT)
        route = (mix(pair + third) % np.uint64(routes)).astype(np.int64)
        strings = [b"", *self.vocabulary]
        pack = zstandard.ZstdCompressor(1).compress
        order = np.argsort(route, kind="stable")
        cuts = np.flatnonzero(np.diff(route[order])) + 1
        for some in np.split(order, cuts):
            used, own = np.unique(suffixes[some], return_inverse=True)
            if used[0]:  # 0 always means the end
                used, own = np.concatenate([[0], used]), own + 1
            text = b"\n".join(strings[k] for k in used[1:].tolist())
            body = np.concatenate([[len(some), len(text)], own.reshape(-1), weights[some]]).astype("<i4").tobytes()
            yield self.lang, int(route[some[0]]), pack(body + text)


def unpacked(blobs: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words (number 0 is the end), suffixes and weights of packed suffixes, in one numbering."""
    known: dict[bytes, int] = {}
    suffixes, weights = [], []
    for blob in blobs:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n, size = np.frombuffer(raw, "<i4", 2)
        body = np.frombuffer(raw, "<i4", int(n) * (LONGEST + 1), 8)
        words = raw[len(raw) - int(size):].split(b"\n")
        ids = np.array([0, *(known.setdefault(w, len(known) + 1) for w in words)], np.int32)
        suffixes.append(ids[body[: n * LONGEST]].reshape(-1, LONGEST))
        weights.append(body[n * LONGEST:].astype(np.int64))
    return [b"", *known], np.concatenate(suffixes), np.concatenate(weights)


def packed_words(words: Counter[bytes], routes: int) -> Iterator[tuple[int, bytes]]:
    """(route, packed words with their counts)."""
    pack = zstandard.ZstdCompressor(1).compress
    own: dict[int, list[bytes]] = {}
    for word in words:
        own.setdefault(zlib.crc32(word) % routes, []).append(word)
    for route, some in own.items():
        counts = np.array([len(some), *(words[w] for w in some)], "<i8").tobytes()
        yield route, pack(counts + b"\n".join(some))


def added_words(blobs: list[bytes]) -> Counter[bytes]:
    """Sum of packed counts."""
    total: Counter[bytes] = Counter()
    for blob in blobs:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        for word, count in zip(raw[8 * (n + 1):].split(b"\n"), np.frombuffer(raw, "<i8", n, 8).tolist()):
            total[word] += count
    return total


def quicksort(suffixes: np.ndarray, weights: np.ndarray, least: int, complete: int = ROUTED) -> Iterator[tuple[int, int, int]]:
    """(a suffix, words, count) of every prefix of two words or more, by multikey three-way quicksort; prefixes of
    ``complete`` words or more count ``least`` or more, shorter ones are all given."""
    waiting = [(np.arange(len(suffixes)), 0)]
    while waiting:
        some, depth = waiting.pop()
        if not len(some) or (depth + 1 >= complete and weights[some].sum() < least):
            continue
        column = suffixes[some, depth]
        pivot = sorted((int(column[0]), int(column[len(column) // 2]), int(column[-1])))[1]
        equal = some[column == pivot]
        waiting += [(some[column < pivot], depth), (some[column > pivot], depth)]
        if not pivot:
            continue
        count = int(weights[equal].sum())
        if depth + 1 < complete or count >= least:
            if depth:
                yield int(equal[0]), depth + 1, count
            if depth + 1 < LONGEST:
                waiting.append((equal, depth + 1))


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a) of all words and phrases that occur ``least`` times, and (lang, n) words of each lang."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counted = materialise(hashed_counts(docs, least), "phrase-slots")
    sizes = counted.where("n is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    bits = spark.sparkContext.broadcast(frequent_slots(counted, least))  # 2.5 MB whatever the input
    total = sizes.agg(F.sum("n")).first()[0] or 0
    routes = max(1, -(-total // ROUTE_WORDS))
    pair_bits, word_bits, chunk, waiting = PAIR_BITS, WORD_BITS, CHUNK, SUFFIXES

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Suffixes] = {}
        single: dict[str, Counter[bytes]] = {}

        def row(lang: str, route: int, suffixes: bytes | None, words: bytes | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([route], pa.int64()), pa.array([suffixes], pa.binary()),
                                               pa.array([words], pa.binary())], ["lang", "route", "suffixes", "words"])

        def suffix_rows(some: Suffixes) -> Iterator[pa.RecordBatch]:
            for lang, route, packed in some.routed(routes):
                yield row(lang, route, packed, None)

        def word_rows(lang: str, words: Counter[bytes]) -> Iterator[pa.RecordBatch]:
            for route, packed in packed_words(words, routes):
                yield row(lang, route, None, packed)

        for lang, data in chunks(batches, chunk):
            words = Words(lang, data)
            some = held.setdefault(lang, Suffixes(lang))
            some.add(words, _set(bits.value, words.pairs(pair_bits)))
            if some.size >= waiting:
                yield from suffix_rows(held.pop(lang))
            often = np.flatnonzero(_set(bits.value, words.words(word_bits, pair_bits)))
            raw = data.tobytes()
            counts = single.setdefault(lang, Counter())
            counts.update(map(raw.__getitem__, map(slice, words.first[often].tolist(), words.last[often].tolist())))
            if len(counts) >= waiting:
                yield from word_rows(lang, single.pop(lang))
        for some in held.values():
            if some.size:
                yield from suffix_rows(some)
        for lang, counts in single.items():
            yield from word_rows(lang, counts)

    def sort(group: pd.DataFrame) -> pd.DataFrame:
        rows = [(word.decode(), count) for word, count in added_words(list(group["words"].dropna())).items() if count >= least]
        packed = list(group["suffixes"].dropna())
        if packed:
            words, suffixes, weights = unpacked(packed)
            rows += [(b" ".join(words[k] for k in suffixes[row, :size].tolist()).decode(), count) for row, size, count in quicksort(suffixes, weights, least)]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "phrase": [p for p, _ in rows], "a": pd.array([c for _, c in rows], "int64")})

    found = materialise(docs.mapInArrow(follow, "lang string, route long, suffixes binary, words binary"), "phrase-suffixes")
    phrases = found.groupBy("lang", "route").applyInPandas(sort, "lang string, phrase string, a long")
    counts = phrases.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return materialise(counts, "phrase-counts"), sizes


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of each lang."""
    counts, sizes = phrase_counts(docs, least)
    words = F.split("phrase", " ")
    candidates = counts.withColumn("words", words).withColumn("size", F.size("words")).where("size > 1")
    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")

    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "size")
    cuts = cuts.select("lang", "phrase", "a", "k", part(1, F.col("k")).alias("head"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(sizes, "lang")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    score = F.call_function("div", (wide("a") * wide("n")).cast("decimal(38,0)") * F.lit(1000).cast("decimal(4,0)"), (wide("l") * wide("r")).cast("decimal(38,0)"))
    lowest = cuts.withColumn("cut", F.struct(score.cast("long").alias("score"), "k", "l", "r")).groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))

    spans = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("size") - n + 1), lambda k: F.array_join(F.slice("words", k, n), " ")))))
    inner = candidates.where("size > 2").select("lang", spans.alias("phrase"), F.col("a").alias("whole"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("whole").alias("whole"))
    kept = lowest.join(inner, ["lang", "phrase"], "left").where("whole is null or whole < a")
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return rows.withColumn("rank", rank.cast("long")).where(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language."""
    return collocations(table(spark, sf_dir, "documents"))


#: DuckDB counterpart of :func:`op11_phrases`.
OP11_SQL = r"""
WITH pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM
         (SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
     split AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS words FROM pieces),
     places AS (SELECT lang, words, unnest(generate_series(1, len(words))) AS spot FROM split WHERE len(words) > 0),
     spans AS (SELECT lang, array_to_string(words[spot:spot + size - 1], ' ') AS phrase, size FROM places, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE spot + size - 1 <= len(words)),
     sizes AS (SELECT lang, count(*) AS n FROM spans WHERE size = 1 GROUP BY 1),
     counts AS (SELECT lang, phrase, size, count(*) AS a FROM spans GROUP BY ALL HAVING count(*) >= 100),
     candidates AS (SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE size > 1),
     cuts AS (SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, n, k, (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
         FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM candidates) c
         JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(words[1:k], ' ')
         JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(words[k + 1:], ' ') JOIN sizes s ON s.lang = c.lang),
     lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     inside AS (SELECT c.lang, array_to_string(words[spot:spot + span - 1], ' ') AS phrase, max(c.a) AS whole
         FROM candidates c, (SELECT unnest([2, 3, 4]) AS span), (SELECT unnest([1, 2, 3, 4]) AS spot) WHERE span < size AND spot + span - 1 <= size GROUP BY 1, 2)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE whole IS NULL OR whole < a
QUALIFY rank <= 2000"""
