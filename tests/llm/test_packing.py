import zlib

import numpy as np
import public_tokenizers
from colloquy.llm import packing, queries
from colloquy.llm.store import Store
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, uid string, length string"
tokenizer = Tokenizer.from_file(FILE)


def check(rows, docs, capacity=4096):
    want = []
    for i, t in docs:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.append((i is None, i or 0, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(want) == sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(w[4] for w in want)
    return len(bins), -(-total // capacity)


@given(st.lists(st.text(max_size=60), max_size=6))
@settings(max_examples=150, deadline=None)
def test_ids_word_by_word(texts):
    got = [packing.encoder(FILE).encode(t) for t in texts]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]


def test_ids_of_odd_texts():
    texts = ["a\x1cb", "x\x85y", "<|endoftext|> a<|startoftext|>b", "é ́", "ΑΣ ΑΣΑ", "I'm they'll 12,5 'S", "﻿z ᠎ q", "a b c", "x" * 5000]
    test_ids_word_by_word.hypothesis.inner_test(texts)


def test_operators_keep_every_piece_once():
    rng = np.random.default_rng(0)
    shard = packing.Shard(rng.integers(1, 900, 300), 1000)
    a, b = shard.first(rng, 0), shard.first(rng, 0.3)
    for child in [shard.cross(a, b, rng), shard.mutate(a, rng), *shard.evolve([a, b], rng)]:
        assert sorted(i for c in child for i in c) == list(range(300))
        assert all(sum(shard.lengths[i] for i in c) <= 1000 for c in child)
    assert np.array_equal(packing._genome(packing._bins(packing._genome(a, 300)), 300), packing._genome(packing._bins(packing._genome(a, 300)), 300))
    assert shard.fitness(shard.evolve([a, b], rng)[0]) >= max(shard.fitness(a), shard.fitness(b))


def test_migration_and_levels(spark, monkeypatch):
    # Pieces over a third of the capacity are hard to pack; small shards make several levels.
    monkeypatch.setattr(packing, "SHARD", 60)
    rng = np.random.default_rng(2)
    lengths = np.concatenate((rng.integers(200, 700, 500), rng.integers(1, 60, 200))).tolist()
    df = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    got = packing.assign(df, Store(spark, "t"), 1000).collect()
    assert sorted(r.uid for r in got) == list(range(700))
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, lengths[r.uid]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1000
    plain = packing.Shard(np.array(lengths), 1000)
    assert len(bins) <= len(plain.first(rng, 0)) * 1.03


def test_memo_stays_within_its_bound(monkeypatch):
    monkeypatch.setattr(packing, "TURNS", 5)
    made, size = [], packing._ENTRY + 5 * 3
    memo = packing.Memo(lambda k: made.append(k) or k.encode(), 100 * size)
    for k in range(150):
        assert memo["hot"] == b"hot" and memo[f"{k:03d}"] == f"{k:03d}".encode()
        assert len(memo) + len(memo.young) <= 100 and memo.bytes + memo.young_bytes <= 100 * size
    # What came first stays, later keys come and go, and at last all is forgotten once.
    assert len(memo) == 75 and made.count("hot") == made.count("000") == 1 and made.count("149") == 1
    assert memo["080"] == b"080" and made.count("080") == 2
    for k in range(150, 400):
        memo[f"{k:03d}"]
    assert memo["000"] == b"000" and made.count("000") == 2


def test_shards_stay_small_where_no_two_pieces_fit(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(k, int(x)) for k, x in enumerate(rng.integers(2100, 4000, 20_000))], "uid long, length long")
    sizes = [len(r.uids) for r in packing.deal(df, 20_000, 0).collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= packing.SHARD
    store = Store(spark, "t")
    got = packing.assign(df, store).collect()
    assert len({r.sequence_id for r in got}) == 20_000
    # All of it was settled at the first level: nothing was dealt again.
    assert store._n <= 2 + 2 * packing.EPOCHS


def test_evolution_gains_bins(spark):
    lengths = np.random.default_rng(7).integers(1100, 2000, 900)
    shards = spark.createDataFrame([(0, lengths.tolist())], "shard long, lengths array<int>")
    row = packing.solve(shards, Store(spark, "t"), 4096).first()
    assert row.bound <= row.n_bins < row.first_bins
    plain = packing.Shard(lengths, 4096)
    assert row.first_bins <= len(plain.first(np.random.default_rng(0), 0))
    fill = np.bincount(np.asarray(row.elite), weights=lengths)
    assert len(fill) == row.n_bins and fill.max() <= 4096


def test_edges(spark):
    docs = [(1, None), (2, ""), (None, "nobody"), (3, "word " * 9000), (3, "word " * 9000), (4, "w " * 4095), (5, "w " * 4096)]
    df = spark.createDataFrame([(*d, "u", "l") for d in docs], SCHEMA)
    bins, bound = check(packing.pack(df, FILE).collect(), docs)
    assert bins <= bound + 1
    assert packing.pack(spark.createDataFrame([], SCHEMA), FILE).collect() == []


def test_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bins, bound = check(queries.op2_packing(spark, sf).collect(), docs)
    assert bins <= bound + 1
