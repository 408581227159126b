"""N-gram Jaccard join over a token-group matrix: every link between different texts, no pairs within a group.

A document's set holds the hashes of its distinct word n-grams (fewer words: the whole sequence). Equal sets
are one node from the start, named by a 64-bit digest of the set (a wrong merge of two sets has odds of 2^-64).
Two nodes link when ``100 * intersection >= percent * union``.

1. One pass sizes the sets and finds tokens that are common within a task; a fixed table of 2^20 bins holds
   their weights. All sets are then read in one global order: bins by weight, then token hash. Any order is
   exact; this one moves boilerplate to the end.
2. Each set writes the first tokens of its order, the prefix. Sets that link share at least k tokens of their
   prefixes (:func:`prefix`, :func:`shared`). Tokens that one set alone holds are dropped.
3. Partition: a set joins the group of the set with which it shares most prefix tokens, out of the smallest set
   of each token; a set left alone joins the group that holds most of its tokens. A group is dealt into units of bounded size, each with the group's centre. In a unit, members
   are compared with a few leaders, those first whose tokens are most common in the unit; whatever stays outside
   the largest component is compared with all members of the unit by its tokens' postings. Small groups and
   lone sets that hold a token of many groups share units with others that hold it, so that a token stands in
   as many units as its sets fill, not in one for each set.
4. Token-group matrix: the distinct (token, unit) pairs of the prefixes, with the components they stand for. A
   set's count of tokens in common with a unit, but not with its own component alone, bounds its overlap with
   every member; only units that reach k are opened. The units of a set's own group are opened without this bound. Of two components the smaller one asks, so a large
   component never asks. An opened unit's union of whole sets must hold percent of the set; only then its
   members are counted out. A component's members are never compared with each other again, so a group of n
   copies costs n rows, not n^2.
5. Components over all links; every document gets its component's smallest doc_id.

Contract: one row per input row. Null, empty and blank texts have empty sets and link with nothing; a null
doc_id takes part in links and is no component's name unless alone. Repeated rows are equal sets. Texts are
read whole; columns other than doc_id and text are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm.common import blocks, buffers, materialise, mix, small_batches, table, word_hashes
from civiclake.llm.components import components

_BINS = 20
#: Tokens and sets of a unit, about.
PART, MEMBERS = 1 << 20, 4096
#: Leaders with which a member of a unit is compared before the exact pass.
LEADERS = 8
#: Families that may hold a token before the small ones among them share units.
CROWD = 32
_STEP = np.uint64(0xD6E8FEB86659FD93)


def least(n: int, percent: int) -> int:
    """The smallest overlap of a set of n tokens with any set it links to."""
    return (percent * n + 99) // 100


def spare(n: int, percent: int) -> int:
    """Tokens that a prefix holds beyond the shortest exact one; each asks for one more common token."""
    return max(0, min(n // 20 + 3, least(n, percent) - 1))


def prefix(n: int, percent: int) -> int:
    """Length of the prefix of a set of n tokens."""
    return n - least(n, percent) + 1 + spare(n, percent)


def shared(n: int, percent: int) -> int:
    """Prefix tokens that a set of n tokens shares with any set it links to (whose size is percent of n at least)."""
    return 1 + spare(least(n, percent), percent)


def _shared_column(n, percent: int):
    """:func:`shared` of a column."""
    low = F.floor((n * percent + 99) / 100)
    return 1 + F.greatest(F.lit(0), F.least(F.floor(low / 20) + 3, F.floor((low * percent + 99) / 100) - 1))


def sets(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The sorted tokens of every text of a block."""
    data, at = buffers(batch.column("text"))
    words, _, _, cut = word_hashes(data, at)
    grams = words.copy()
    for j in range(1, width):
        grams = mix(grams[: len(words) - j] * _STEP + words[j:]) if len(words) > j else grams[:0]
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= width:
            yield np.unique(grams[a: b - width + 1])
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = mix(whole * _STEP + words[k: k + 1])
            yield whole
        else:
            yield np.empty(0, np.uint64)


def digest(tokens: np.ndarray) -> int:
    """Names a set: a digest of its sum, its mixed sum and its size."""
    total = np.array([tokens.sum() ^ np.uint64(len(tokens)), mix(tokens).sum()])
    return int(mix(total[:1] * _STEP + mix(total[1:])).view(np.int64)[0])


def _survey(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, row, n, sig) per document, and (bin, weight) for tokens that are common within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, total = np.zeros(1 << _BINS, np.int64), 0
        for batch in blocks(batches):
            each = list(sets(batch, width))
            tokens = np.concatenate(each)
            bins += np.bincount((tokens >> np.uint64(64 - _BINS)).astype(np.int64), minlength=1 << _BINS)
            total += len(tokens)
            n = len(each)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), batch.column("row"), pa.array([len(x) for x in each], pa.int64()),
                pa.array([digest(x) if len(x) else None for x in each], pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())],
                ["doc_id", "row", "n", "sig", "bin", "weight"])
        heavy = np.flatnonzero(bins >= 8 + 4 * total / (1 << _BINS))
        none = pa.nulls(len(heavy), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(heavy, pa.int32()), pa.array(bins[heavy], pa.int64())],
                                         ["doc_id", "row", "n", "sig", "bin", "weight"])

    return docs.mapInArrow(run, "doc_id long, row long, n long, sig long, bin int, weight long")


def _classes(survey: DataFrame) -> np.ndarray:
    """Rank of every bin in the global order: 0 for most, else the magnitude of its weight. At most 2^20 rows."""
    out = np.zeros(1 << _BINS, np.uint8)
    rows = survey.where("bin is not null").groupBy("bin").agg(F.sum("weight").alias("weight")).toPandas()
    out[rows["bin"].to_numpy(np.int64)] = 1 + np.log2(rows["weight"].to_numpy(float)).astype(np.uint8)
    return out


def _prefixes(docs: DataFrame, classes, width: int, percent: int) -> DataFrame:
    """(token, sig, n) of the prefixes; a task writes a repeated set once while it remembers it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        ranks = classes.value
        for batch in blocks(batches):
            tokens, names, sizes = [np.empty(0, np.uint64)], [], []
            for each in sets(batch, width):
                n = len(each)
                if n < 2:
                    continue  # a single token links with nothing but its equal
                name = digest(each)
                if name in known:
                    continue
                if len(known) > 500_000:
                    known.clear()
                known.add(name)
                rank = ranks[(each >> np.uint64(64 - _BINS)).astype(np.int64)]
                if rank.any():
                    each = each[np.argsort(rank, kind="stable")]
                first = each[: prefix(n, percent)]
                tokens.append(first)
                names.append(name)
                sizes.append((n, len(first)))
            of = np.array([s[1] for s in sizes], np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(names, np.int64), of)),
                pa.array(np.repeat(np.array([s[0] for s in sizes], np.int32), of))], ["token", "sig", "n"])

    return docs.select("text").mapInArrow(run, "token long, sig long, n int")


def _whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(sig, n, tokens) of the wanted sets, from one row each (sig, of); of is the row's hash of id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            each = list(sets(batch, width))
            yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array([len(x) for x in each], pa.int32()),
                                              pa.array([x.tobytes() for x in each], pa.binary())], ["sig", "n", "tokens"])

    texts = docs.select("row", "text").join(wanted.withColumnRenamed("of", "row"), "row").select("sig", "text").dropDuplicates(["sig"])
    return texts.mapInArrow(run, "sig long, n int, tokens binary")


class _Postings:
    """Sets of a unit with their tokens' postings."""

    def __init__(self, names: list[int], tokens: list[np.ndarray]):
        self.names, self.tokens = names, tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        every = np.concatenate(tokens)
        order = np.argsort(every, kind="stable")
        self.every, self.owner = every[order], np.repeat(np.arange(len(names)), self.sizes)[order]

    def centrality(self) -> np.ndarray:
        """Mean number of sets of the unit that hold a token of each set."""
        counts = np.searchsorted(self.every, self.every, "right") - np.searchsorted(self.every, self.every, "left")
        return np.bincount(self.owner, counts, len(self.names)) / self.sizes

    def links(self, tokens: np.ndarray, percent: int) -> np.ndarray:
        """Places of all sets that link to the given one."""
        low, high = np.searchsorted(self.every, tokens), np.searchsorted(self.every, tokens, "right")
        count = high - low
        if 100 * np.count_nonzero(count) < percent * len(tokens):  # the union holds too little of it
            return np.empty(0, np.int64)
        at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        common = np.bincount(self.owner[at], minlength=len(self.names))
        return np.flatnonzero(100 * common >= percent * (len(tokens) + self.sizes - common))


def _root(parent: list[int], k: int) -> int:
    while parent[k] != k:
        parent[k] = k = parent[parent[k]]
    return k


def _pools(kept: DataFrame, units: DataFrame) -> DataFrame:
    """(family, pool) of the small families that hold a token of more than CROWD families: the unit that they share."""
    held = kept.where("crowded").select("token", "sig").join(units.select("sig", "family"), "sig").select("token", "family").distinct()
    crowds = held.groupBy("token").agg(F.count("*").alias("families")).where(F.col("families") > CROWD)
    small = units.groupBy("family").agg(F.sum("n").alias("tokens"), F.count("*").alias("members"))
    small = small.where((F.col("tokens") * 4 <= PART) & (F.col("members") * 4 <= MEMBERS))
    chosen = held.join(crowds, "token").groupBy("family").agg(F.max(F.struct("families", "token")).alias("crowd"))
    chosen = chosen.join(small, "family").select("family", "tokens", "members", F.col("crowd.token").alias("token"))
    parts = chosen.groupBy("token").agg(F.greatest(F.ceil(F.sum("tokens") / PART), F.ceil(F.sum("members") / MEMBERS)).cast("int").alias("parts"))
    return chosen.join(parts, "token").select("family", F.xxhash64("token", F.pmod(F.xxhash64("family"), F.col("parts")).cast("int")).alias("pool"))


def _units(kept: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(sig, n, family, unit) of every set, and (unit, sig) of all places where a set is compared; a family is a group, a lone set or a pool of small ones."""
    sizes = kept.select("sig", "n").distinct()
    centre = kept.select("sig", "n", F.col("first").alias("centre")).where("sig <> centre")
    centre = centre.groupBy("sig", "n", "centre").agg(F.count("*").alias("common")).where(F.col("common") >= _shared_column(F.col("n"), percent))
    best = centre.groupBy("sig", "n").agg(F.max(F.struct("common", "centre")).alias("best")).select("sig", "n", F.col("best.centre").alias("centre"))
    # Sets whose tokens are split over several smallest sets join the group that holds most of them.
    placed = best.select("sig", F.col("centre").alias("family")).unionByName(
        best.select(F.col("centre").alias("sig"), F.col("centre").alias("family")).distinct().join(best.select("sig"), "sig", "left_anti"))
    placed = materialise(placed, "families")
    held = kept.select("token", "sig").join(placed, "sig").select("token", "family").distinct()
    lone = kept.select("token", "sig", "n").join(placed, "sig", "left_anti").join(held, "token").groupBy("sig", "n", "family").agg(F.count("*").alias("common"))
    lone = lone.where(F.col("common") >= _shared_column(F.col("n"), percent)).groupBy("sig", "n").agg(F.max(F.struct("common", "family")).alias("best"))
    best = materialise(best.unionByName(lone.select("sig", "n", F.col("best.family").alias("centre"))), "groups")
    parts = best.groupBy("centre").agg(F.greatest(F.ceil(F.sum("n") / PART), F.ceil(F.count("*") / MEMBERS)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int")
    members = best.join(parts, "centre").select("sig", "centre", F.xxhash64("centre", part).alias("unit"))
    middle = parts.select(F.col("centre").alias("sig"), "parts")
    homes = middle.select("sig", F.xxhash64("sig", part).alias("home"))
    units = sizes.join(members, "sig", "left").join(homes, "sig", "left").select(
        "sig", "n", F.coalesce("centre", "sig").alias("family"), F.coalesce("unit", "home", F.xxhash64("sig")).alias("unit"))
    places = middle.select("sig", F.explode(F.expr("sequence(0, parts - 1)")).alias("part")).select(F.xxhash64("sig", "part").alias("unit"), "sig")
    units = materialise(units, "units")
    pools = materialise(_pools(kept, units), "pools")
    pooled = units.join(pools, "family")
    places = places.unionByName(members.select("unit", "sig")).join(pooled.select("unit", "pool").distinct(), "unit", "left")
    places = places.select(F.coalesce("pool", "unit").alias("unit"), "sig").unionByName(pooled.select(F.col("pool").alias("unit"), "sig")).distinct()
    units = units.join(pools, "family", "left").select("sig", "n", F.coalesce("pool", "family").alias("family"), F.coalesce("pool", "unit").alias("unit"))
    return units, places


def _inside(places: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what links inside the units."""

    def connect(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("sig").sort_values("sig")
        unit = _Postings(group["sig"].tolist(), [np.frombuffer(t, np.uint64) for t in group["tokens"]])
        parent = list(range(len(unit.names)))
        links: list[tuple[int, int]] = []

        def join(a: int, b: int) -> None:
            x, y = _root(parent, a), _root(parent, b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((unit.names[a], unit.names[b]))

        leaders: list[int] = []
        for k in np.argsort(-unit.centrality(), kind="stable").tolist():
            if len(leaders) >= LEADERS:
                break
            if not any(_root(parent, k) == _root(parent, leader) for leader in leaders):
                leaders.append(k)
                for other in unit.links(unit.tokens[k], percent).tolist():
                    join(k, other)
        roots = np.array([_root(parent, k) for k in range(len(parent))])
        largest = np.bincount(roots).argmax()
        for k in np.flatnonzero(roots != largest).tolist():
            for other in unit.links(unit.tokens[k], percent).tolist():
                join(k, other)
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    rows = places.join(whole.select("sig", "tokens"), "sig").select("unit", "sig", "tokens")
    return rows.groupBy("unit").applyInPandas(connect, "a long, b long")


def _opened(kept: DataFrame, whole: DataFrame, units: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components: the matrix, its bound, and the comparison in the units that reach it."""
    named = units.join(labels, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    named = materialise(named.join(named.groupBy("label").agg(F.count("*").alias("size")), "label").select("sig", "n", "family", "unit", F.struct("size", "label").alias("comp")), "units")
    placed = kept.select("token", "sig").join(named, "sig")
    matrix = placed.groupBy("token", F.col("unit").alias("asked"), F.col("family").alias("other")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("comp").alias("top"))
    # A component asks only where a greater one, by size and name, holds the token; one of any two does.
    hits = (placed.join(matrix, "token").where("family <> other and comp < top")
            .where((F.col("high") * 100 >= F.col("n") * percent) & (F.col("low") * percent <= F.col("n") * 100)))
    asked = (hits.groupBy("sig", "n", "asked").agg(F.count("*").alias("common")).where(F.col("common") >= _shared_column(F.col("n"), percent))
             .select("sig", "n", "asked"))
    tops = named.groupBy("family", F.col("unit").alias("asked")).agg(F.max("comp").alias("top"))
    within = named.join(tops, "family").where("unit <> asked and comp < top").select("sig", "n", "asked")
    asked = materialise(asked.unionByName(within), "asked")
    columns = asked.groupBy("asked").agg(F.greatest(F.ceil(F.sum("n") / PART), F.ceil(F.count("*") / MEMBERS)).cast("int").alias("columns"))
    left = named.select("sig", F.col("unit").alias("asked"), F.col("comp.label").alias("label")).join(columns, "asked")
    left = left.select("asked", F.explode(F.expr("sequence(0, columns - 1)")).alias("column"), "sig", "label")
    right = asked.join(columns, "asked").join(named.select("sig", F.col("comp.label").alias("label")), "sig")
    right = right.select("asked", F.pmod(F.xxhash64("sig"), F.col("columns")).cast("int").alias("column"), "sig", "label")
    rows = left.withColumn("member", F.lit(True)).unionByName(right.withColumn("member", F.lit(False))).join(whole.select("sig", "tokens"), "sig")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        members, queries = group[group["member"]], group[~group["member"]]
        unit = _Postings(members["sig"].tolist(), [np.frombuffer(t, np.uint64) for t in members["tokens"]])
        labels = members["label"].to_numpy()
        links = []
        for sig, label, raw in zip(queries["sig"].tolist(), queries["label"], queries["tokens"]):
            found = unit.links(np.frombuffer(raw, np.uint64), percent)
            found = found[labels[found] != label]
            for k in np.unique(labels[found], return_index=True)[1]:
                links.append((sig, unit.names[found[k]]))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return rows.select("asked", "column", "sig", "label", "member", "tokens").groupBy("asked", "column").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("row", F.xxhash64("doc_id", "text"))  # an id alone may stand on several texts, or be null
    survey = materialise(_survey(docs, width), "survey")
    nodes = survey.where("bin is null").select("doc_id", "row", "n", "sig")
    classes = spark.sparkContext.broadcast(_classes(survey))

    rows = _prefixes(docs, classes, width, percent).repartition("token")
    common = rows.groupBy("token").agg(F.min("sig").alias("first"), F.max("sig").alias("last"), F.count("*").alias("sets")).where("first <> last")
    common = common.select("token", "first", (F.col("sets") > CROWD).alias("crowded"))
    kept = materialise(rows.join(common, "token").distinct(), "prefixes")
    able = kept.groupBy("sig", "n").agg(F.count("*").alias("common")).where(F.col("common") >= _shared_column(F.col("n"), percent)).select("sig")
    kept = materialise(kept.join(able, "sig", "left_semi"), "candidates")

    wanted = nodes.join(able, "sig").groupBy("sig").agg(F.min("row").alias("of"))
    whole = materialise(_whole_sets(docs, wanted, width), "sets")
    units, places = _units(kept, percent)
    labels = components(materialise(_inside(places, whole, percent), "inside"))
    between = materialise(_opened(kept, whole, units, labels, percent), "between")
    # The links inside units enter as (set, label), so the second run starts from finished components.
    labels = components(labels.select(F.col("sig").alias("a"), F.col("label").alias("b")).unionByName(between))

    placed = nodes.join(labels, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    names = placed.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("name"))
    return placed.join(names, "label", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("name", "doc_id").alias("component_id"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: four words, 85 percent."""
    return near_duplicates(table(spark, sf_dir, "documents"))
