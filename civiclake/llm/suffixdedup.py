"""Removal of repeated byte strings by suffix arrays of shards.

Every byte covered by a string of ``length`` bytes that also starts anywhere else goes. Strings are windows;
all statements below are exact.

1. Candidates. Each window is keyed by the smallest hash of the ``ANCHOR``-byte strings inside it, so equal
   windows have equal keys. Neighbouring windows with one key form a segment (key, place, windows). A key that
   occurs in one segment only, and once in it, repeats nothing and goes, which leaves little of a corpus.
2. Equal segments. Segments of a key with equal bytes (by a 64-bit BLAKE2 digest within the key) repeat each other entirely.
   Where a key has several different segments, one of each is sorted.
3. Shards. Segments are dealt to shards by key, so equal windows meet. A shard's suffix array is built by
   Larsson-Sadakane refinement: ranks of 8 bytes, then doubled depths inside the groups still unsorted. Kasai's
   rule gives the common prefixes of neighbours: only where the preceding bytes differ they are compared. A
   window repeats if it shares ``length`` bytes with a neighbour.
4. Merging. A key with more text than a shard holds is dealt over several. Their sorted windows are cut at the
   borders of digest ranges by binary search; per range, the runs of all shards meet and are merged by binary
   search.
5. Windows found so become spans of the document, merged, and cut out.

Contract: one row per input row. Null texts are empty; texts below ``length`` bytes stay whole. Repeated rows
are documents like others: their text repeats and goes. Rows are told apart by a 64-bit hash of doc_id and
text. Cutting bytes can split a character; :func:`drop_repeats` then leaves the broken bytes out. Extra columns
are kept by :func:`drop_repeats`, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm.common import blocks, buffers, free_name, materialise, mix, powers, small_batches, table

LENGTH = 200
ANCHOR = 32
#: Windows of a segment, at most: 2^12.
_CUT = 12
#: Text bytes of a shard.
SHARD = 2 << 20


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash modulo 2^64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=out[1:])
    return out


def _digests(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit BLAKE2 digests of the strings [first, last)."""
    raw = memoryview(data.tobytes())
    found = b"".join([hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(first.tolist(), last.tolist())])
    return np.frombuffer(found, np.uint64)


def _window_keys(sums: np.ndarray, n: int, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest anchor hash of each window, and the anchor hashes; both per first byte, as far as they fit."""
    hashes = mix((sums[anchor:] - sums[:-anchor]) * powers(n + 1)[1][: n - anchor + 1])
    width, low, have = length - anchor + 1, hashes, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = width - have
    return (np.minimum(low[: len(low) - rest], low[rest:]) if rest else low), hashes


def segments(data: np.ndarray, at: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Segments of a block of texts: text number, first window (in the text), windows, key, digest, whether a key recurs inside."""
    n = len(data)
    if n < length:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    sums = _sums(data)
    keys, hashes = _window_keys(sums, n, length, anchor)
    valid = np.zeros(n + 1, np.int8)
    long = np.flatnonzero(np.diff(at) >= length)
    valid[at[long]] += 1
    valid[at[long + 1] - length + 1] -= 1
    valid = np.cumsum(valid[: len(keys)]).astype(bool)
    going = valid[1:] & valid[:-1] & (keys[1:] == keys[:-1])  # the next window belongs to the same segment
    start = valid.copy()
    start[1:] &= ~going
    begin = np.flatnonzero(start)
    end = np.append(begin[1:], len(keys))
    end = np.minimum(end, begin + np.add.reduceat(valid.astype(np.int64), begin)) if len(begin) else end
    pieces = (end - begin - 1 >> _CUT) + 1
    if len(pieces) and pieces.max() > 1:
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, end = np.repeat(begin, pieces) + (nth << _CUT), np.repeat(end, pieces)
        end = np.minimum(end, begin + (1 << _CUT))
    # A key recurs inside a segment where its first place leaves the windows and the key stays.
    leaves = np.append(going & (hashes[: len(keys) - 1] == keys[:-1]), False)
    total = np.concatenate([[0], np.cumsum(leaves)])
    recurs = total[end - 1] > total[begin]
    text = np.searchsorted(at, begin, side="right") - 1
    return text, begin - at[text], end - begin, keys[begin], _digests(data, begin, end + length - 1), recurs


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks, by Larsson and Sadakane: only groups that are not yet in order are sorted again."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k: k + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    heads = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    del key, sorted_key
    # Suffixes shorter than 8 bytes may tie with longer ones that go on with zero bytes; later depths part them.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    open_ = ~heads
    open_[:-1] |= ~heads[1:]
    where = np.flatnonzero(open_)  # places in the order whose groups have several members
    depth = 8
    while len(where):
        some = order[where]
        group = rank[some]
        beyond = some + depth
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        place = np.argsort(group << 32 | second, kind="stable")
        some, group, second = some[place], group[place], second[place]
        order[where] = some
        new = np.ones(len(where), bool)
        new[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        rank[some] = where[np.maximum.accumulate(np.where(new, np.arange(len(where)), 0))]
        still = ~new
        still[:-1] |= ~new[1:]
        where = where[still]
        depth *= 2
    return order, rank


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Kasai: bytes that each suffix shares with its predecessor in the array, in the order of the text.

    Where the bytes before a suffix and its predecessor agree, the value is one less than that of the suffix
    before; only the other places are compared, eight bytes at a time, all at once.
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    places = np.arange(n)
    fresh = (before <= 0) | (places == 0)
    fresh[1:] |= text[places[1:] - 1] != text[before[1:] - 1]
    todo = np.flatnonzero(fresh & (before >= 0))
    words = np.concatenate([text, np.zeros(16, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(words, 8)
    shares = np.zeros(n, np.int64)
    a, b, at = todo, before[todo], todo
    while len(at):  # whole words first
        inside = (np.maximum(a, b) + 8 <= n)
        same = inside & (eight[np.minimum(a, n)] == eight[np.minimum(b, n)]).all(axis=1)
        left = ~same
        for k in range(8):  # the bytes of the word that differs
            if not left.any():
                break
            x, y = a[left] + k, b[left] + k
            ok = (np.maximum(x, y) < n) & (words[np.minimum(x, n)] == words[np.minimum(y, n)])
            stay = np.flatnonzero(left)
            shares[at[stay[ok]]] += 1
            left[stay[~ok]] = False
        shares[at[same]] += 8
        a, b, at = a[same] + 8, b[same] + 8, at[same]
    source = np.maximum.accumulate(np.where(fresh, places, 0))
    return np.maximum(shares[source] - (places - source), 0)


def repeated_windows(parts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each window of the parts shares its bytes with another: (flags per byte, first byte of each part, text).

    Parts are joined by a byte that UTF-8 never holds, so no window reaches over a border.
    """
    text = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)
    first = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
    order, rank = suffix_array(text)
    shares = common_prefixes(text, order, rank)
    flags = shares >= length
    follows = order[:-1][flags[order[1:]]]
    flags[follows] = True
    return flags, first, text


def _runs(flags: np.ndarray) -> np.ndarray:
    """(first, behind the last) of each run of true flags."""
    steps = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return steps.reshape(-1, 2)


def _sort_shard(group: pd.DataFrame) -> pd.DataFrame:
    """Runs of repeated windows of each segment of a shard; of keys dealt over several shards also the open windows."""
    group = group.drop_duplicates(["key", "digest"]).reset_index(drop=True)
    flags, first, text = repeated_windows(group["bytes"].tolist())
    out = []
    for k, (key, dig, raw, parts, many) in enumerate(zip(group["key"], group["digest"], group["bytes"], group["parts"], group["many"])):
        windows = len(raw) - LENGTH + 1
        own = flags[first[k]: first[k] + windows]
        if not many and own.any():
            out.append((key, dig, _runs(own).astype("<i4").tobytes(), -1, None))
        if parts > 1:  # windows are cut into ranges of their hashes by binary search in the sorted list
            places = np.arange(windows)
            hashes = _digests(text[first[k]: first[k] + len(raw)], places, places + LENGTH)
            ranked = np.argsort(hashes)
            hashes = hashes[ranked]
            borders = np.searchsorted(hashes, _borders(parts))
            for r, (a, b) in enumerate(zip(np.append(0, borders), np.append(borders, windows))):
                if b > a:
                    packed = np.empty(b - a, [("hash", "<u8"), ("at", "<i4")])
                    packed["hash"], packed["at"] = hashes[a:b], ranked[a:b]
                    out.append((key, dig, None, r, packed.tobytes()))
    return pd.DataFrame(out, columns=["key", "digest", "runs", "range", "open"]).astype({"key": "int64", "digest": "int64", "range": "int32"})


def _borders(parts: int) -> np.ndarray:
    """Inner borders of equal ranges of the hash space."""
    return np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)


def _merge_range(group: pd.DataFrame) -> pd.DataFrame:
    """Windows that occur in several segments of one key, within one range of their hashes."""
    packs = [np.frombuffer(raw, [("hash", "<u8"), ("at", "<i4")]) for raw in group["open"]]
    owner = np.repeat(np.arange(len(packs)), [len(p) for p in packs])
    every = np.concatenate(packs)
    merged = np.sort(every["hash"])
    again = np.searchsorted(merged, every["hash"], "right") - np.searchsorted(merged, every["hash"], "left") > 1
    out = []
    keys, digs = group["key"].tolist(), group["digest"].tolist()
    for k in np.unique(owner[again]):
        at = np.sort(every["at"][again & (owner == k)]) if len(packs) < 64 else np.sort(packs[k]["at"][again[np.searchsorted(owner, k): np.searchsorted(owner, k, "right")]])
        flags = np.zeros(at[-1] + 1, bool)
        flags[at] = True
        out.append((keys[k], digs[k], _runs(flags).astype("<i4").tobytes()))
    return pd.DataFrame(out, columns=["key", "digest", "runs"]).astype({"key": "int64", "digest": "int64"})


def _with_row(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__row", F.xxhash64("doc_id", "text"))


def _segment_rows(docs: DataFrame) -> DataFrame:
    """(key, digest, row, place): place packs the first window, the number of windows less one and the recurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=1 << 20):
            text, first, windows, keys, digests, recurs = segments(*buffers(batch.column("text")))
            rows = batch.column("__row").to_numpy()[text] if len(text) else np.empty(0, np.int64)
            place = first << (_CUT + 1) | (windows - 1) << 1 | recurs
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(digests.view(np.int64)), pa.array(rows), pa.array(place)],
                                             ["key", "digest", "row", "place"])

    return docs.select("__row", "text").mapInArrow(run, "key long, digest long, row long, place long")


def _packed(docs: DataFrame) -> DataFrame:
    """(row, packed): texts compressed before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in blocks(batches):
            data, at = buffers(batch.column("text"))
            packed = [packer.compress(data[a:b].tobytes()) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("__row"), pa.array(packed, pa.binary())], ["row", "packed"])

    return docs.select("__row", "text").mapInArrow(run, "row long, packed binary")


def _cut_segments(texts: DataFrame) -> DataFrame:
    """(key, digest, many, bytes, parts) of the segments asked for, from (row, packed, wanted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for raw, wanted in zip(batch.column("packed").to_pylist(), batch.column("wanted").to_pylist()):
                text = unpacker.decompress(raw)
                for w in wanted:
                    first, windows = w["place"] >> (_CUT + 1), (w["place"] >> 1 & (1 << _CUT) - 1) + 1
                    out.append((w["key"], w["digest"], w["many"], text[first: first + windows + LENGTH - 1], w["parts"]))
                    held += windows + LENGTH
                if held > 4 << 20:
                    yield _segment_batch(out)
                    out, held = [], 0
            if out:
                yield _segment_batch(out)

    return texts.mapInArrow(run, "key long, digest long, many boolean, bytes binary, parts int")


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], ["key", "digest", "many", "bytes", "parts"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(row, spans) of all texts with repeated strings; spans are (first window, behind the last window). ``docs`` has __row."""
    rows = _segment_rows(docs)
    recurs, windows = F.col("place").bitwiseAND(1), F.shiftright("place", 1).bitwiseAND((1 << _CUT) - 1) + 1
    # Partial sums per task go first, so a passage of a third of all documents arrives as a row per task.
    keys = rows.groupBy("key").agg(F.sum(1 + recurs).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"), F.max(recurs).alias("recurs"))
    keys = keys.where("n > 1").select("key", ((F.col("low") != F.col("high")) | (F.col("recurs") == 1)).alias("sort"))
    kept = materialise(rows.join(keys, "key"), "segments")

    each = kept.groupBy("key", "digest").agg(F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("first"), F.max("sort").alias("sort"))
    each = materialise(each, "distinct")
    to_sort = each.where("sort").select("key", "digest", (F.col("n") > 1).alias("many"), F.col("first.row").alias("row"), F.col("first.place").alias("place"))
    sizes = to_sort.groupBy("key").agg(F.sum(windows + LENGTH - 1).alias("bytes")).select("key", "bytes", F.ceil(F.col("bytes") / SHARD).cast("int").alias("parts"))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // SHARD))
    wanted = to_sort.join(sizes.select("key", "parts"), "key").groupBy("row").agg(F.collect_list(F.struct("key", "digest", "many", "place", "parts")).alias("wanted"))
    texts = _packed(docs).dropDuplicates(["row"]).join(wanted, "row").select("packed", "wanted")
    dealt = _cut_segments(texts)
    # A key that fits goes to one shard; the parts of a larger one go by the segment.
    own = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("key", F.pmod(F.xxhash64("digest"), F.col("parts"))), F.lit(shards))).otherwise(F.pmod(F.xxhash64("key"), F.lit(shards)))
    sorted_ = dealt.withColumn("shard", own).groupBy("shard").applyInPandas(
        lambda group: _sort_shard(group), "key long, digest long, runs binary, range int, open binary")
    sorted_ = materialise(sorted_, "sorted")
    merged = sorted_.where("open is not null").select("key", "digest", "range", "open").groupBy("key", "range").applyInPandas(
        lambda group: _merge_range(group), "key long, digest long, runs binary")
    found = sorted_.where("runs is not null").select("key", "digest", "runs").unionByName(merged)

    whole = each.where("n > 1").select("key", "digest", F.lit(None).cast("binary").alias("runs"))
    told = kept.join(whole.unionByName(found), ["key", "digest"])
    first = F.shiftright("place", _CUT + 1)
    return told.select("row", first.alias("first"), windows.cast("int").alias("windows"), "runs").groupBy("row").agg(
        F.collect_set(F.struct("first", "windows", "runs")).alias("spans"))


def covered(text_bytes: int, spans: list[dict], length: int = LENGTH) -> np.ndarray:
    """(first, behind the last) removed byte of each maximal run."""
    edges = []
    for s in spans:
        if s["runs"] is None:
            edges.append([[s["first"], s["first"] + s["windows"]]])
        else:
            edges.append(np.frombuffer(s["runs"], "<i4").reshape(-1, 2).astype(np.int64) + s["first"])
    both = np.concatenate(edges)
    both = both[np.argsort(both[:, 0], kind="stable")]
    first, last = both[:, 0], np.minimum(np.maximum.accumulate(both[:, 1]) + length - 1, text_bytes)
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > last[:-1]
    starts = np.flatnonzero(new)
    return np.stack([first[starts], last[np.append(starts[1:], len(first)) - 1]], axis=1)


def _kept(text: bytes, spans: list[dict] | None) -> tuple[bytes, np.ndarray]:
    if not spans:
        return text, np.empty((0, 2), np.int64)
    cut = covered(len(text), spans)
    edges = [0, *cut.reshape(-1).tolist(), len(text)]
    return b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])]), cut


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    small_batches(docs.sparkSession)
    docs = _with_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")))
    spans = materialise(repeated_spans(docs), "spans")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in blocks(batches):
            data, at = buffers(batch.column("text"))
            packed = [packer.compress(data[a:b].tobytes()) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("__row"), pa.array(packed, pa.binary())], ["doc_id", "row", "packed"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for doc_id, packed, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "spans"))):
                text = unpacker.decompress(packed)
                left, runs = _kept(text, found)
                rows.append((doc_id, len(text), len(text) - len(left), len(runs), hashlib.sha256(left).hexdigest()))
            if rows:
                kinds = [pa.int64()] * 4 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)

    packed = docs.select("doc_id", "__row", "text").mapInArrow(pack, "doc_id long, row long, packed binary")
    return packed.join(spans, "row", "left").select("doc_id", "packed", "spans").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated strings cut out of ``text``; the other columns stay."""
    small_batches(docs.sparkSession)
    row, held = free_name(docs, "__row"), free_name(docs, "__spans")
    rows = docs.withColumn(row, F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    spans = materialise(repeated_spans(rows.select(F.col(row).alias("__row"), F.coalesce("text", F.lit("")).alias("text"))), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column("text").to_pylist(), batch.column(held).to_pylist()
            left = [t if not s else _kept(t.encode(), s)[0].decode("utf-8", "ignore") for t, s in zip(texts, found)]
            names = [c for c in batch.schema.names if c != held]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()) if c == "text" else batch.column(c) for c in names], names)

    joined = rows.join(spans.select(F.col("row").alias(row), F.col("spans").alias(held)), row, "left").drop(row)
    return joined.mapInArrow(cut, docs.schema)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 200-byte strings of all documents."""
    return digests(table(spark, sf_dir, "documents"))
