"""Token counts, BPE and token-id files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from civiclake.llm import bpe, idfile, tokencount
from civiclake.llm.bpe import Bpe, vocabulary
from civiclake.llm.common import shared_dir
from civiclake.llm.files import make_folder, open_file

ODD = ["", " ", "a", "\t\n ", "don't  STOP 'LL", "<|endoftext|>x<|startoftext|>", "<|endoftext", "été Straße ΣΣ ΟΔΟΣ", "漢字かな 𝕏Ⅷ½", "áé", "x" * 700,
       "!" * 90, "  　y", "\x00\x01\x1c\x1f\x85", "▁▁ a ▁b", "<0x41><s></s>", "\U0001f600\U0001f600", "l'été's I'M"]


def texts(n=300, seed=4):
    pick = random.Random(seed)
    pool = [chr(c) for c in [*range(32, 127), *range(161, 0x250), *range(0x391, 0x3C9), 0x4E00, 0x1F600, 9, 10]]
    return ODD + ["".join(pick.choices(pool, k=pick.randint(0, 60))) for _ in range(n)] + [" ".join(pick.choices(["the", "tion", "ings", "zu"], k=pick.randint(1, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(vocabulary())
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def test_bpe_matches_the_library(library):
    own = Bpe(vocabulary())
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_frame(spark, library):
    rows = [(k, t, "x") for k, t in enumerate(ODD)] + [(99, None, None), (None, "a b", "y"), (5, ODD[4], "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    made = bpe.encode(df, vocabulary()).collect()
    assert len(made) == len(rows)
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        wanted = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        if doc_id != 5:
            assert [tuple(r[1:]) for r in made if r.doc_id == doc_id] == [wanted]
    whole = {r.doc_id: r for r in bpe.encode(df.where("doc_id = 4"), vocabulary(), emit="ids").collect()}
    assert whole[4].ids == library.encode(ODD[4], add_special_tokens=False).ids and whole[4].decoded == library.decode(whole[4].ids, skip_special_tokens=False)
    assert bpe.encode(df.limit(0), vocabulary()).count() == 0


def unigram(pieces, byte_fallback):
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=byte_fallback))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return tokenizer


def test_counts_match_the_library():
    pieces = tokencount.load_pieces(vocabulary("piece_bpe_32k.model"))
    own, other = tokencount.Counter(pieces), unigram(pieces, True)
    for text in texts():
        assert sum(map(own.word, own.words(text))) == len(other.encode(text).ids), text


def test_ties_and_unknowns():
    pieces = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aba", -3.0), ("▁a", -2.0), ("ba", -2.0)]
    own, other = tokencount.Counter(pieces), unigram(pieces, False)
    pick = random.Random(1)
    for _ in range(500):
        text = "".join(pick.choices("ab xy", k=pick.randint(0, 14)))
        assert sum(map(own.word, own.words(text))) == len(other.encode(text).ids), text


def test_count_frame(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "x" * 5000)], "doc_id long, text string")
    made = sorted((r.doc_id or 0, r.n_tokens) for r in tokencount.count_tokens(df, vocabulary("piece_bpe_32k.model")).collect())
    assert len(made) == 5 and made[1] == made[2] and (2, 0) in made and (3, 0) in made and made[0][1] > 0


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000, idfile.BLOCK + 3])
def test_block_round_trip(n):
    ids = np.random.default_rng(n).integers(0, 49_408, n).astype(np.uint32)
    assert (idfile.unpack_block(idfile.pack_block(ids)) == ids).all() and len(idfile.unpack_block(idfile.pack_block(ids))) == n


def test_block_of_large_and_zero_ids():
    for ids in (np.zeros(50, np.uint32), np.array([0, 2**32 - 1, 5], np.uint32)):
        assert idfile.unpack_block(idfile.pack_block(ids)).tolist() == ids.tolist()


def test_id_files(spark, library):
    pick = random.Random(2)
    rows = [(k, " ".join(pick.choices(["the", "ings", "zu"], k=pick.randint(0, 120))), "z") for k in range(150)] + [(200, None, ""), (None, "b", ""), (7, "a", ""), (7, "a", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    folder = shared_dir(spark, "ids-test")
    make_folder(folder)
    idfile.write(df, folder, vocabulary(), block=64).write.parquet(folder + "-index")
    files = idfile.with_starts(spark.read.parquet(folder + "-index"))
    made = sorted(idfile.read(files).collect(), key=lambda r: r.start)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0], len(r[1] or ""), r[1] or ""))
    start = 0
    for row, (doc_id, text, _) in zip(made, ordered, strict=True):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    whole = {r.doc_id: r.ids for r in idfile.read(files, "ids").collect()}
    assert whole[None] == library.encode("b", add_special_tokens=False).ids + [1] and whole[200] == [1]
    first = files.orderBy("part").first()
    with open_file(first.path) as file:
        reader = idfile.FileReader(file)
        for k, (_, ids) in enumerate(reader):
            assert reader.document(k).tolist() == ids.tolist()
    assert idfile.write(df.limit(0), folder, vocabulary()).count() == 0
