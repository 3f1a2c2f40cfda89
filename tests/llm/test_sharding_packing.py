"""Rendezvous sharding and best-fit packing."""

import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contractflow.llm import packing, rendezvous
from contractflow.llm.base import settings as session_settings

import helpers


def shard_of(key, weights):
    best = None
    for i, w in enumerate(weights):
        h = xxhash.xxh64_intdigest(str(key).encode() if key is not None else b"\0", 42)
        h = xxhash_int(i, h)
        u = ((h >> 11) + 0.5) / (1 << 53)
        s = (-math.log(u) / w, i)
        best = s if best is None or s < best else best
    return best[1]


def xxhash_int(value, seed):
    """XXH64 of a 32-bit integer, as Spark hashes an int column."""
    return xxhash.xxh64_intdigest(value.to_bytes(4, "little", signed=True), seed)


def test_shards_by_brute_force_and_odd_rows(spark):
    session_settings(spark)
    rows = helpers.odd_rows() + [(i, f"t{i}", "en", "a", 1) for i in range(100, 400)]
    out = rendezvous.assign_shards(helpers.clash(helpers.docs(spark, rows)), [1.0, 2.0, 1.0], grown=[1.0, 2.0, 1.0, 1.0]).collect()
    assert len(out) == len(rows)
    by_id = {}
    for r in out:
        assert r["shard"] == shard_of(r["doc_id"], [1.0, 2.0, 1.0])
        assert r["grown_shard"] in (r["shard"], 3)
        by_id.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_id.values())
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    for r in out:
        if r["doc_id"] is not None:
            body = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(body) + 1, zlib.crc32(body))
    share = sum(r["shard"] == 1 for r in out) / len(out)
    assert 0.4 < share < 0.6
    assert rendezvous.assign_shards(helpers.docs(spark, []), [1.0]).count() == 0
    with pytest.raises(ValueError):
        rendezvous.rendezvous(F.col("doc_id"), [1.0, 0.0])


def test_written_shards_hold_whole_rows(spark, tmp_path):
    rows = helpers.odd_rows()
    rendezvous.write_shards(helpers.docs(spark, rows), [1.0] * 4, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert helpers.rows_of(back.drop("_shard")) == helpers.rows_of(helpers.docs(spark, rows))


def check_packing(spark, rows, limit=64, **options):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    out = packing.pack(helpers.clash(helpers.docs(spark, rows)), limit, **options).collect()
    want = []
    for r in rows:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), limit)):
            part = ids[at:at + limit]
            want.append((r[0], k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in out)
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(bins), sum(w[3] for w in want)


def test_packing_by_the_tokenizer_itself(spark):
    session_settings(spark)
    rng = random.Random(1)
    rows = helpers.odd_rows() + [(i, helpers.prose(rng, rng.randint(1, 40)), "en", "a", 1) for i in range(100, 500)]
    rows += [(600, "Don't <|endoftext|> x\x1cy á ΑΣ 1+1=2 <|startoftext|>b", "en", "a", 1)]
    bins, tokens = check_packing(spark, rows)
    assert bins <= 1.05 * tokens / 64 + 2
    check_packing(spark, rows, open_bins=2, group_rows=100)
    assert packing.pack(helpers.docs(spark, [])).count() == 0


def test_sequences_can_be_built_from_their_pieces(spark):
    session_settings(spark)
    rng = random.Random(2)
    rows = helpers.odd_rows() + [(i, helpers.prose(rng, rng.randint(1, 60)), "en", "a", 1) for i in range(100, 160)]
    tok = packing.word_tokens(packing.tokenizer_path()).tokenizer
    made, back = {}, {}
    for r in packing.pack(helpers.docs(spark, rows), 64).collect():
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        made.setdefault(r["sequence_id"], []).append((r["offset"], r["ids"]))
        if r["doc_id"] not in (None, 2):
            back.setdefault(r["doc_id"], []).append((r["start"], r["ids"]))
    for parts in made.values():
        sequence = []
        for offset, ids in sorted(parts):
            assert offset == len(sequence)
            sequence += ids
        assert len(sequence) <= 64
    for r in rows:
        if r[0] not in (None, 2):
            assert [i for _, ids in sorted(back[r[0]]) for i in ids] == tok.encode(r[1] or "", add_special_tokens=False).ids + [0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 12))
def test_best_fit_keeps_its_promises(sizes, open_bins):
    bins, free, open_now = packing.BestFit(50, open_bins), {}, set()
    for n in sizes:
        fits = [free[b] for b in open_now if free[b] >= n]
        number, offset = bins.put(n)
        if fits:
            assert free[number] == min(fits)
        else:
            assert offset == 0
            if len(open_now) >= open_bins:
                fullest = min(free[b] for b in open_now)
                open_now.remove(next(b for b in open_now if free[b] == fullest and b not in [x for s in bins.bins for x in s]))
            free[number] = 50
        assert offset == 50 - free[number]
        free[number] -= n
        open_now = {b for s in bins.bins for b in s}
        assert len(open_now) <= open_bins


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_word_tokens_equal_the_tokenizer(text):
    tokens = packing.word_tokens(packing.tokenizer_path())
    text = text.encode("utf-8", "ignore").decode()
    got = np.frombuffer(next(iter(tokens([text.encode()]))), "<u4").tolist()
    assert got == tokens.tokenizer.encode(text, add_special_tokens=False).ids
