"""Conversation repair against a search over all audits."""

import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from contractflow.llm import conversations as C
from contractflow.llm.base import settings as session_settings

import helpers

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def plain(symbols):
    """Cheapest (cost, audit) by trying all edits, shortest audits first, in a table of the best by (turns read, roles so far)."""
    n = len(symbols)
    best = [[None] * 4 for _ in range(n + 1)]
    best[0][0] = (0, "")
    for i in range(n + 1):
        for _ in range(4):  # up to three inserted turns in a row are ever useful
            for q in range(4):
                if best[i][q]:
                    to, label = (2, 2, 3, 2)[q], (best[i][q][0] + 3, best[i][q][1] + "I")
                    if best[i][to] is None or label < best[i][to]:
                        best[i][to] = label
        if i == n:
            break
        s = symbols[i]
        more = 3 if s.isupper() else 0
        for q in range(4):
            if best[i][q] is None:
                continue
            c, a = best[i][q]
            edits = [(q, c + 4, a + "D")]
            if s != "-":
                edits.append(((2, 2, 3, 2)[q], c + 3 + more, a + "R"))
                kept = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "x": {}}[s.lower()].get(q)
                if kept is not None:
                    edits.append((kept, c + more, a + "K"))
            for to, cost, audit in edits:
                if best[i + 1][to] is None or (cost, audit) < best[i + 1][to]:
                    best[i + 1][to] = (cost, audit)
    return min(x for x in (best[n][0], best[n][3]) if x)


SYMBOLS = "-suaxSUAX"


@settings(max_examples=300, deadline=None)
@given(st.text(SYMBOLS, max_size=40))
def test_search_by_brute_force(symbols):
    assert C.cheapest(symbols, 0, (0, 3)) == plain(symbols)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(80, 700))
def test_blocks_join_to_the_same_audit(seed, n):
    rng = random.Random(seed)
    symbols = "".join(rng.choice("suauaua-xUA") for _ in range(n))
    assert C.repair(symbols) == plain(symbols)
    cuts = sorted(rng.sample(range(n), 3))
    pieces = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, n])]
    assert C.complete(C.reduced([C.paths(p) for p in pieces])) == plain(symbols)


def test_all_audits_of_short_conversations():
    """Every sequence of edits, with the pattern checked by itself."""
    import re
    from itertools import product

    def outcomes(symbols, inserts=2):
        for edits in product("KRD", repeat=len(symbols)):
            for places in product(range(inserts + 1), repeat=len(symbols) + 1):
                audit = "".join("I" * k + e for k, e in zip(places, [*edits, ""]))
                slots = [s.lower() if e == "K" else "?" for e, s in zip(edits, symbols)]
                options = []
                for k, e, s in zip(places, [*edits, "D"], [*slots, ""]):
                    options += ["?"] * k + ([s] if e != "D" else [])
                if any(e != "D" and s == "-" for e, s in zip(edits, symbols)):
                    continue
                pattern = "".join("[ua]" if o == "?" else o for o in options)
                size = len(options)
                targets = [""] if not size else [x for x in ("ua" * size, "s" + "ua" * size) for x in [x[:size]] if x.endswith("a")]
                if any(re.fullmatch(pattern, t) for t in targets):
                    cost = 3 * sum(places) + sum({"K": 0, "R": 3, "D": 4}[e] for e in edits)
                    yield cost + 3 * sum(e != "D" and s.isupper() for e, s in zip(edits, symbols)), audit

    rng = random.Random(1)
    for n in range(5):
        for _ in range(25):
            symbols = "".join(rng.choice(SYMBOLS) for _ in range(n))
            assert C.repair(symbols) == min(outcomes(symbols)), symbols


def with_faults(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: text.translate(str.maketrans("", "", ".!?"))}.get(fault, text)
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def expected(rows, faults=True):
    changed, out, all_turns = with_faults(rows) if faults else rows, [], []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in changed if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        seen, symbols, counts = set(), "", [0, 0, 0]
        for _, _, role, text in mine:
            body = text.strip(" \t\n\x0b\x0c\r")
            s = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not body:
                counts[0] += 1
                s = "-"
            elif (role, text) in seen:
                counts[1] += 1
                s = "-"
            elif body[-1] not in ".!?":
                counts[2] += 1
                s = s.upper()
            seen.add((role, text))
            symbols += s
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = plain(symbols)
        left, i, after = [], 0, None
        for edit in audit:
            if edit != "I":
                _, _, role, text = mine[i]
                i += 1
            else:
                role, text = None, ""
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if after == "u" else "user"
            left.append((role, text))
            after = role[:1]
        all_turns += [(conv, k, *t) for k, t in enumerate(left)]
        body = "\n".join(f"{r}:{t}" for r, t in left)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest(), len(left)))
    return sorted(out, key=repr), sorted(all_turns, key=repr)


def some_rows(seed, conversations=60):
    rng, rows = random.Random(seed), []
    for conv in range(conversations):
        roles = ["system"] * (rng.random() < 0.3) + ["user", "assistant"] * rng.randint(0, 5) + [rng.choice(["user", "tool", "", "Assistant", None])]
        for turn, role in enumerate(roles):
            text = rng.choice(["Yes.", "no", f"Line {rng.random()}.", f"cut {rng.random()}", "two\nlines!", " ", "", None, "Ü é? "])
            rows.append((conv, rng.choice([turn, turn * 2, turn]) if rng.random() < 0.8 else turn, role, text))
    numbered, seen = [], set()
    for r in rows:  # equal turn numbers are tested apart, as their order is this library's own
        if (r[0], r[1]) not in seen:
            numbered.append(r)
            seen.add((r[0], r[1]))
    return numbered


def test_query_by_brute_force_and_odd_rows(spark, tmp_path):
    session_settings(spark)
    rows = some_rows(1) + [(None, 1, "user", "A."), (None, None, "assistant", "B."), (900, None, None, None), (901, 5, "system", "Only.")]
    rng = random.Random(2)
    rng.shuffle(rows)
    frame = helpers.clash(spark.createDataFrame(rows, ROWS))
    frame.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    assert helpers.rows_of(C.op13(spark, str(tmp_path))) == expected(rows)[0]
    empty = C.records(C.damaged(spark.createDataFrame([], ROWS)), present="_present")
    assert C.reports(empty).count() == 0 and C.repaired_turns(empty).count() == 0


def test_hot_conversation_over_many_tasks_and_chunks(spark):
    session_settings(spark)
    rng = random.Random(7)
    rows = some_rows(3, 40)
    rows += [(7, 100 + i, rng.choice(["user", "assistant", "assistant", "user", "system"]),
              rng.choice(["Yes.", f"It is {i}.", f"cut {i}", "", f"Well {i % 50}!"])) for i in range(3000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
        want_reports, want_turns = expected(clean, faults=False)
        found = C.records(spark.createDataFrame(rows, ROWS).repartition(5), chunk_rows=150)
        assert helpers.rows_of(C.reports(found)) == want_reports
        assert helpers.rows_of(C.repaired_turns(found)) == want_turns
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_equal_turn_numbers_go_by_role_and_repeats_stay_together(spark):
    session_settings(spark)
    rows = [(1, 0, "user", "A."), (1, 0, "assistant", "B."), (1, 0, "user", "A."), (1, 1, "user", "C."), (1, 2, "assistant", "D.")]
    (r,) = C.reports(C.records(spark.createDataFrame(rows, ROWS))).collect()
    # In order: assistant B, user A, user A again, user C, assistant D.
    assert (r["duplicate"], r["illegal"], r["audit"], r["cost"]) == (1, 2, *reversed(plain("au-ua")))
