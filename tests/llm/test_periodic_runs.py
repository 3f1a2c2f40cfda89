"""Periodic runs against a search of every period."""

import hashlib
import random
import zlib
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from contractflow.llm import periodic_runs as P
from contractflow.llm.base import settings as session_settings

import helpers


def smallest_period(words):
    """From the border table of the words."""
    border, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1]


def every_run(words, min_words=24, periods=3):
    n, out = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_words, periods * q) and smallest_period(words[i:i + length]) == q:
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=250, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 40), st.integers(0, 130), st.integers(0, 2 ** 32)), min_size=1, max_size=8))
def test_runs_by_brute_force(parts):
    texts = [[]]
    for letters, period, length, seed in parts:
        rng = random.Random(seed)
        block = [bytes([97 + rng.randrange(letters)]) for _ in range(period)]
        texts[-1] += [block[i % period] for i in range(length)]
        if rng.random() < 0.3:
            texts.append([])
    assert P.text_runs(texts) == [every_run(t) for t in texts]


def test_strings_with_many_repetitions_inside_their_period():
    """Fibonacci and de Bruijn-like words repeated: blocks recur long before the period does."""
    fib = [b"a", b"ab"]
    while len(fib[-1]) < 200:
        fib.append(fib[-1] + fib[-2])
    for block in [fib[-1][:89], fib[-1][:55], b"ab" * 9 + b"c", b"a" * 20 + b"b", b"abababac" * 4 + b"d", b"aab" * 11 + b"aaab" * 5]:
        for times in (3, 4, 7):
            words = [bytes([x]) for x in b"xyz" + block * times + b"q"]
            assert P.text_runs([words, words[::-1], []]) == [every_run(words), every_run(words[::-1]), []]


def changed(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_by_brute_force_and_odd_rows(spark, tmp_path):
    session_settings(spark)
    rng = random.Random(3)
    rows = [r for r in helpers.odd_rows() if r[0] != 6] + [(i, helpers.prose(rng, rng.randint(1, 300)), "en", "a", 1) for i in range(100, 260)]
    rows += [(300, "go on " * 40, "en", "a", 1), (301, "a b c d e f g h " * 3 + "x", "en", "a", 1), (302, "a " * 23, "en", "a", 1)]
    helpers.clash(helpers.docs(spark, rows)).write.parquet(str(tmp_path / "documents.parquet"))
    out = P.op11(spark, str(tmp_path)).collect()
    expected = []
    for row in rows:
        words = changed(row[0], row[1])
        runs = every_run(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None, None, None)
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        left = b" ".join(w for i, w in enumerate(words) if i not in drop)
        milli = 1000 * best[1] // best[2] if runs else None
        expected.append((row[0], len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest(), len(words)))
    assert helpers.rows_of(spark.createDataFrame(out)) == sorted(expected, key=repr)
    assert sum(r[1] for r in expected) >= 10
    assert P.periodic_runs(helpers.docs(spark, [])).count() == 0


def test_long_text_in_one_piece(spark):
    rng = random.Random(9)
    words = [str(rng.randrange(10 ** 6)) for _ in range(100_000)]
    body = words[:50_000] + words[30_000:50_000] * 3 + ["end"] + ["la"] * 300_000
    session_settings(spark)
    (row,) = P.periodic_runs(helpers.docs(spark, [(1, " ".join(body), "en", "a", 1)])).collect()
    assert [tuple(r) for r in row["runs"]] == [(30_000, 80_000, 20_000), (110_001, 300_000, 1)]
    assert row["collapsed"].split() == words[:50_000] + ["end", "la"]
