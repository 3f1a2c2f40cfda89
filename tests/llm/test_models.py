"""Language model, Kneser-Ney classifier, toxicity."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contractflow.llm import QUERIES, kneser_ney, mixing_lm, toxicity
from contractflow.llm.base import settings as session_settings
from contractflow.session import stage

import helpers

FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["\n"]


def test_counts_by_brute_force_and_better_than_counts(spark):
    out = {r["doc_id"]: r for r in QUERIES["op3_context_mixing_lm"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    c = collections.Counter(t for r in docs if not held(r["doc_id"]) for t in tokens(r["text"]))
    n, v = sum(c.values()), len(c)
    assert len(out) == len(docs)
    for r in docs:
        own, got = tokens(r["text"]), out[r["doc_id"]]
        base = sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own)
        assert (got["held_out"], got["n_tokens"], got["n_known"], got["train_tokens"]) == (held(r["doc_id"]), len(own), sum(c[t] > 0 for t in own), n)
        assert abs(base - got["base_score"]) < 1e-6 * abs(base) + 1e-6 and got["score"] < 0
    mine = [r for r in out.values() if r["held_out"]]
    assert sum(r["score"] for r in mine) > sum(r["base_score"] for r in mine)


def test_odd_rows_and_rare_tokens(spark):
    session_settings(spark)
    docs = helpers.clash(helpers.docs(spark, helpers.odd_rows()))
    model = mixing_lm.learn(docs, F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False)), head=5)
    c = collections.Counter(t for r in helpers.odd_rows() for t in tokens(r[1]))
    out = mixing_lm.score(docs, model).collect()
    assert len(out) == len(helpers.odd_rows()) and len(model.head.value) <= 5
    whole = math.log10(sum(c.values()) + len(c) + 1)
    want = sorted(repr((r[0], len(tokens(r[1])), round(sum(math.log10(c[t] + 1) - whole for t in tokens(r[1])), 4))) for r in helpers.odd_rows())
    assert want == sorted(repr((r["doc_id"], r["n_tokens"], round(r["base_score"], 4))) for r in out)
    same = [r["score"] for r in out if r["doc_id"] in (1, 2)]
    assert max(same) - min(same) < 1e-3
    none = mixing_lm.learn(helpers.docs(spark, []), F.lit(False))
    assert mixing_lm.score(helpers.docs(spark, []), none).count() == 0
    assert all(math.isfinite(r["score"]) and r["n_known"] == 0 for r in mixing_lm.score(docs, none).collect())


def test_probabilities_of_all_next_steps_add_to_one():
    """At each node both steps are predicted before either is seen, so a word's steps are a code."""
    code = mixing_lm.Code.of(np.arange(1 << 16))
    assert np.allclose((2.0 ** -code.length.reshape(256, 256)).sum(axis=1), 1)
    words = [b"abc", b"a", mixing_lm.END_TOKEN, mixing_lm.NEW_TOKEN, "é".encode()]
    sizes = np.concatenate([n for n, *_ in mixing_lm.steps(words, code)])
    ends = []
    for w in words:
        path = w if w in (mixing_lm.END_TOKEN, mixing_lm.NEW_TOKEN) else w + b" "
        ends.append(sum(code.length[256 * a + b] for a, b in zip(b" " + path, path)))
    assert sizes.tolist() == ends


def test_blocks_do_not_depend_on_other_texts():
    rng = np.random.default_rng(0)
    first = np.array([0, 40, 90, 170, 180])
    x, gate, bit = rng.normal(size=(180, mixing_lm.K)).astype(np.float32), rng.integers(0, mixing_lm.GATES, 180), rng.integers(0, 2, 180).astype(np.uint8)
    new, start = np.array([False, True, False]), np.full((mixing_lm.GATES, mixing_lm.K), 0.3)
    texts = [rng.integers(0, 3, n) for n in (1, 50, 7, 400, 0)]
    whole = mixing_lm.mixed(first, x, gate, bit, texts, new, start)
    for i, t in enumerate(texts):
        alone = mixing_lm.mixed(first, x, gate, bit, [t], new, start)
        assert abs(alone[0][0] - whole[0][i]) < 1e-2 and abs(alone[1][0] - whole[1][i]) < 1e-2


def test_weights_by_gate_and_bias_by_level():
    """One text, step by step, against a plain twin."""
    m = mixing_lm
    assert m.ORDERS == (1, 2, 3, 5)
    rng = np.random.default_rng(1)
    first = np.array([0, 3000, 3008])
    x = (rng.normal(size=(3008, m.K)) * 3).astype(np.float32)
    gate, bit = rng.integers(0, m.GATES, 3008), (rng.random(3008) < 0.8).astype(np.uint8)
    start = rng.normal(size=(m.GATES, m.K)) * 0.3
    w, bias, want = start.copy(), np.zeros(m.LEVELS), 0.0
    for at, n in m.block_sizes(3000):
        dw, db = np.zeros_like(w), np.zeros_like(bias)
        for i in range(at, min(3000, at + n)):
            z = float(x[i] @ w[gate[i]])
            level = int(min(max(z + m.LEVELS // 2, 0), m.LEVELS - 1))
            p = 1 / (1 + math.exp(-min(max(z + bias[level], -16), 16)))
            want += math.log(p if bit[i] else 1 - p)
            dw[gate[i]] += (bit[i] - p) * x[i]
            db[level] += bit[i] - p
        w += m.RATE * min(1.0, 256 / n) * dw
        bias += m.BIAS_RATE * min(1.0, 64 / n) * db
    got, _ = m.mixed(first, x, gate, bit, [np.array([0])], np.array([False]), start)
    assert abs(got[0] - want) < 1e-3 * abs(want)


def test_all_tokens_claim_slots_and_features_are_kept(spark):
    """Contexts of rare tokens count, whatever ``head`` is, and steps that a worker kept are those made anew."""
    session_settings(spark)
    m = mixing_lm
    docs = helpers.docs(spark, [(i, "often often common", "en", "s", 18) for i in range(5)] + [(9, "rarest", "en", "s", 6)])
    model = m.learn(docs, F.col("doc_id") == 1, head=1)
    t, owner, found = model.tables.value, model.owner.value, [b"often", b"rarest", b"common", m.END_TOKEN]
    for _, slots, check, _ in m.steps([b"rarest"], t.code):
        own = np.array([owner[k][slots[k]] == check[k] for k in range(m.K)])
        assert own.mean() > 0.9 and (t.stretch[m.K - 1][slots[m.K - 1]] != 0).mean() > 0.9
    held = m.Features(t, owner, room=120)
    for words in (found[:2], found, [*reversed(found)], [], found[2:]):
        order, *got = held.of(words)
        want = m.inputs([*[words[i] for i in order], m.NEW_TOKEN], t, owner)
        assert sorted(order) == list(range(len(words))) and all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))


def test_tokens_of_a_batch_are_those_of_each_text():
    for texts in ([" a  b\x0b\x1cC\x85 ", "", None, "\x1f  z\x00y", "A a É é\t\n"], [None], ["  "], ["q q"]):
        column = pa.array(["zz k", *texts, "hh"], pa.string()).slice(1, len(texts))
        found, ids, first = mixing_lm.tokens_of(column)
        found = mixing_lm.plain(found)
        got = [[found[i] for i in ids[a:b]] for a, b in zip(first, first[1:])]
        assert got == [[w.encode() for w in tokens(t)] for t in texts]
        assert len(set(found)) == len(found) == len(set(ids.tolist()))


def test_rows_of_a_step_are_small_and_parts_of_a_block_are_scored_alike(monkeypatch):
    """Eight bytes a step, mixed as the predictions themselves are, however many texts go through a block at a time."""
    m = mixing_lm
    rng = np.random.default_rng(2)
    first, n = np.array([0, 300, 700, 708]), 708
    said, gate, bit = rng.integers(-80, 80, (n, m.K)).astype(np.int8), rng.integers(0, m.GATES, n), rng.integers(0, 2, n).astype(np.uint8)
    rows = np.zeros((n, m._ROW), np.int8)
    rows[:, :m.K], rows[:, m.K], rows[:, m.K + 1] = said, gate, 2 * bit.astype(np.int8) - 1
    texts, new, start = [rng.integers(0, 2, k) for k in (1, 9, 30, 2, 0)], np.array([False, True]), np.full((m.GATES, m.K), 0.3)
    want = m.mixed(first, said / np.float32(10), gate, bit, texts, new, start)
    for part in (64, 200, 1 << 14):
        monkeypatch.setattr(m, "_PART", part)
        assert all(np.allclose(a, b, rtol=1e-5, atol=1e-6) for a, b in zip(m.mixed_rows(first, rows.copy(), texts, new, start, 0.1), want))


def test_only_words_worth_keeping_are_kept():
    m = mixing_lm
    t = m.Tables(m.Code.of(np.arange(1 << 16)), np.zeros((m.K, 1 << m.TABLE_BITS), np.int8), np.zeros(1 << m.TABLE_BITS, np.uint8))
    owner = np.zeros((m.K, 1 << m.TABLE_BITS), np.uint8)
    held = m.Features(t, owner, room=500)
    assert held.kept.nbytes == 500 * 8
    for _ in range(2):
        order, first, rows = held.of([b"rare", b"often", b"once"], np.array([False, True, False]))
        assert list(held.words) == [b"often"] and sorted(order) == [0, 1, 2] and len(rows) == first[-1]


def test_whole_fold_sets_the_weights(spark, monkeypatch):
    seen = {}

    class Enough(Exception):
        pass

    def learn(docs, fold, **_):
        seen["ids"] = {r["doc_id"] for r in docs.where(fold).collect()}
        raise Enough

    monkeypatch.setattr(mixing_lm, "learn", learn)
    try:
        QUERIES["op3_context_mixing_lm"](spark, FOLDER)
    except Enough:
        pass
    ids = [r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert seen["ids"] == {d for d in ids if zlib.crc32(str(d).encode()) % 7 == 3} != set()


def kn_twin(texts, order):
    """Plain interpolated modified Kneser-Ney over bytes."""
    counts = {order: collections.Counter()}
    for t in texts:
        body = b"\n" * (order - 1) + t.translate(kneser_ney._BLANK)
        counts[order].update(body[i:i + order] for i in range(len(t)))
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    d = {}
    for n, c in counts.items():
        k = collections.Counter(c.values())
        y = k[1] / (k[1] + 2 * k[2]) if k[1] else 0.5
        d[n] = [min(i, max(0.05, i - (i + 1) * y * k[i + 1] / k[i])) if k[i] else 0.5 * i for i in (1, 2, 3)]

    def p(g, n):
        if n == 0:
            return 1 / 256
        g = g[len(g) - n:]
        own = [(x, c) for x, c in by[n].get(g[:-1], ())]
        if not own:
            return p(g, n - 1)
        total = sum(c for _, c in own)
        off = lambda c: d[n][min(c, 3) - 1]
        c = counts[n].get(g, 0)
        return (max(0, c - off(c)) if c else 0) / total + sum(off(c) for _, c in own) / total * p(g, n - 1)

    by = {n: {} for n in counts}
    for n, c in counts.items():
        for g, k in c.items():
            by[n].setdefault(g[:-1], []).append((g, k))
    return p


def test_kneser_ney_learns_from_every_trusted_document(spark):
    """No bound on trusted documents, and quantiles that are exact without holding a group."""
    docs = spark.range(41_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    counts = []
    train = kneser_ney.train
    try:
        kneser_ney.train = lambda d, text="text": (counts.append(d.count()), train(d, text))[1]
        kneser_ney.classify(docs, labels)
    finally:
        kneser_ney.train = train
    assert counts == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(41_000))]
    rows = [(None if i % 3 == 0 else "ab"[i % 2], float(x)) for i, x in enumerate(np.random.default_rng(2).normal(size=700).round(2))] + [("one", 4.0)]
    values = spark.createDataFrame(rows, "g string, x double")
    wanted = {"low": 0.002, "mid": 0.5, "high": 0.995}
    got = {r["g"]: r for r in kneser_ney.exact_quantiles(values, "g", "x", wanted, cells=3).collect()}
    want = values.groupBy("g").agg(F.count("*").alias("held"), *[F.percentile("x", q).alias(k) for k, q in wanted.items()]).collect()
    assert len(got) == len(want) == 4
    for r in want:
        assert got[r["g"]]["held"] == r["held"] and all(got[r["g"]][k] == pytest.approx(r[k], abs=1e-12) for k in wanted)


def test_kneser_ney_by_brute_force_and_in_shards(spark):
    session_settings(spark)
    rng = random.Random(3)
    rows = [(i, helpers.prose(rng, 40), "en", "a", 1) for i in range(12)] + [(90, None, "en", "a", 1), (91, "é", "fr", "a", 1)]
    model = kneser_ney.train(helpers.docs(spark, rows))
    twin = kn_twin([(r[1] or "").encode() for r in rows], kneser_ney.ORDER)
    tests = [b"Andi ko", b"", b"zzz \xc3\xa9\x09x", helpers.prose(rng, 20).encode()]
    want = []
    for t in tests:
        body = kneser_ney.PAD + t.translate(kneser_ney._BLANK)
        want.append(sum(math.log(twin(body[i:i + 5], 5)) for i in range(len(t))))
    for shard_rows in (10**6, 300):
        parts = list(kneser_ney.model_shards(model, shard_rows))
        got = sum(kneser_ney.log_probability(tests, *p) for p in parts)
        assert np.allclose(got, want, rtol=1e-4, atol=1e-3)
    assert len(parts) > 1
    at = b"\n\n\n\n"
    assert abs(sum(twin(at + bytes([b]), 5) for b in range(256)) - 1) < 1e-9


def test_classifier_on_odd_rows_and_without_labels(spark):
    session_settings(spark)
    docs = helpers.clash(helpers.docs(spark, helpers.odd_rows())).drop("perplexity")
    out = kneser_ney.classify(docs, spark.createDataFrame([], helpers.LABELS)).collect()
    assert len(out) == len(helpers.odd_rows())
    assert all(r["kept"] == (r["n_bytes"] > 0) for r in out)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 9)] + [(1, 1, 0), (None, 1, 1)], helpers.LABELS)
    one = kneser_ney.classify(docs, labels).collect()
    many = kneser_ney.classify(docs, labels, shard_rows=3000).collect()
    assert sorted(repr((r["doc_id"], round(r["log10_p"], 2))) for r in one) == sorted(repr((r["doc_id"], round(r["log10_p"], 2))) for r in many)
    assert kneser_ney.classify(helpers.docs(spark, []), spark.createDataFrame([], helpers.LABELS)).count() == 0


def test_classifier_keeps_clean_documents(spark):
    out = QUERIES["op8_kneser_ney_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = out.join(labels, "doc_id").select("quality", "kept").collect()
    good, bad = [r["kept"] for r in rows if r["quality"] == 1], [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.93 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_folding():
    assert toxicity.fold("1d10t IDІOT іdіоt c1own") == "idiot idiot idiot ciown"
    assert toxicity.words_of("l0s3r! $tupid st$pid 1234 4.5 réeux, x|y") == ["ioser", "stupid", "stspid", "reeux", "xiy"]


def test_hits_and_exceptions():
    lexicon = toxicity.Lexicon({"idiot": 3.0, "scum*": 2.0}, {("idiot", "savant")}, (-3.0, 2.0, 1.0, 1.0))
    hits = lambda t: sorted(w for w, _ in lexicon.hits(toxicity.words_of(t)))
    assert hits("an idiot, a scumbag and an id1ot") == ["idiot", "idiot", "scum*"]
    assert hits("an idiot savant") == [] and hits("idiotic") == [] and hits("") == []
    assert lexicon.score("you idiot scum") > 0.9 > 0.1 > lexicon.score("a fine day")


def test_learned_lexicon_on_held_out_labels(spark):
    rows = QUERIES["op9_lexicon_toxicity"](spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    toxic, other = [r["predicted"] for r in rows if r["toxic"] == 1], [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(toxic) >= 0.88 * len(toxic) and sum(other) <= 0.01 * len(other)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_on_odd_rows(spark):
    session_settings(spark)
    docs = helpers.clash(helpers.docs(spark, helpers.odd_rows()))
    for rows in ([], [(1, 1, 1)], [(1, 1, 1), (8, 1, 0), (None, None, None), (3, 1, 0)]):
        lexicon = toxicity.learn(docs, spark.createDataFrame(rows, helpers.LABELS))
        out = toxicity.score(docs, lexicon).collect()
        assert len(out) == len(helpers.odd_rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score(helpers.docs(spark, []), lexicon).count() == 0


def test_bounds_are_own_quantiles_where_a_language_has_enough_documents(spark):
    """Two languages: with quantiles that need 10 documents the common one keeps its own tails, the rare one may take wider ones."""
    rng = random.Random(5)
    words = ["river", "stone", "apple", "light", "green", "house", "paper", "cloud"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(3, 30))), "xx" if i < 400 else "yy", "s") for i in range(420)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    out = {r["doc_id"]: r for r in kneser_ney.classify(docs, labels, quantiles=(0.1, 0.9), shard_rows=200).collect()}
    held = [math.log(out[i]["perplexity"]) for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    low, high = np.quantile(held, [0.1, 0.9])
    assert len(held) >= 10
    assert math.log(out[0]["low"]) == pytest.approx(low, rel=1e-9) and math.log(out[0]["high"]) == pytest.approx(high, rel=1e-9)
    rare = [math.log(out[i]["perplexity"]) for i in range(400, 420) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert rare and math.log(out[400]["low"]) <= np.quantile(rare, 0.1) + 1e-9 and math.log(out[400]["high"]) >= np.quantile(rare, 0.9) - 1e-9


def test_kneser_ney_model_has_no_join_without_a_key(spark, monkeypatch):
    plans = []

    def seen(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, purpose)

    monkeypatch.setattr(kneser_ney, "stage", seen)
    model = kneser_ney.train(spark.createDataFrame([(1, "some text of a few words")], "doc_id long, text string"))
    assert model.where("n = 1").count() > 0 and len(plans) > kneser_ney.ORDER
    assert not [p for p in plans if "CartesianProduct" in p or "NestedLoop" in p]
