"""SimHash near-duplicates, line dedup and decontamination."""

import random
import re

import xxhash

from contractflow.llm import QUERIES, components, decontaminate, line_dedup, simhash
from contractflow.llm.base import settings as session_settings

import helpers


def print_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, linked):
    """Lowest id of the component of each (id, value)."""
    root = list(range(len(items)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i][1], items[j][1]):
                a, b = top(i), top(j)
                root[max(a, b, key=lambda k: k)] = min(a, b)
    low = {}
    for i, (name, _) in enumerate(items):
        if name is not None:
            low[top(i)] = min(low.get(top(i), name), name)
    return [low.get(top(i)) for i in range(len(items))]


def test_near_duplicates_by_brute_force(spark):
    session_settings(spark)
    rng = random.Random(3)
    rows = helpers.odd_rows()
    for i in range(40):
        words = helpers.prose(rng, 200).split(" ")
        for k in range(rng.randint(1, 4)):
            rows.append((100 + 10 * i + k, " ".join(words), "en", "a", 1))
            words[rng.randrange(len(words))] = "changed"
    out = simhash.near_duplicates(helpers.clash(helpers.docs(spark, rows))).collect()
    prints = [(r[0], print_of(r[1])) for r in rows]
    want = groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(repr((p[0], p[1], w)) for p, w in zip(prints, want)) == sorted(
        repr((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"])) for r in out)
    kept = simhash.keep_first(helpers.docs(spark, rows)).collect()
    ids = [r["doc_id"] for r in kept]
    assert len(ids) == len(set(ids)) and set(ids) == {w for w in want if w is not None}
    assert simhash.near_duplicates(helpers.docs(spark, [])).count() == 0
    assert simhash.keep_first(helpers.docs(spark, [])).count() == 0


def near_chain():
    """Three texts: the second is within two bits of both others, these are not of each other."""
    rng = random.Random(11)
    for _ in range(50):
        words = helpers.prose(rng, 400).split(" ")
        texts = []
        for k in range(12):
            texts.append(" ".join(words))
            words[rng.randrange(len(words))] = f"changed{k}"
        prints = [print_of(t) for t in texts]
        for i in range(12):
            for j in range(12):
                for k in range(i):
                    if (prints[i] ^ prints[k]).bit_count() > 2 >= max((prints[j] ^ prints[k]).bit_count(), (prints[j] ^ prints[i]).bit_count()):
                        return texts[k], texts[j], texts[i]


def test_rows_of_null_or_shared_ids_go_by_their_texts(spark):
    session_settings(spark)
    rng = random.Random(12)
    a, b, c = near_chain()
    alone, other = helpers.prose(rng, 60), helpers.prose(rng, 60)
    rows = [(1, a, "en", "a", 1), (None, b, "en", "a", 1), (2, c, "en", "a", 1), (3, None, "en", "a", 1), (None, "", "en", "a", 1),
            (None, alone, "en", "a", 1), (None, alone, "en", "b", 1), (4, other, "en", "a", 1), (4, a, "en", "a", 1)]
    out = simhash.near_duplicates(helpers.docs(spark, rows)).collect()
    of = {(r["doc_id"], r["fp"] & (1 << 64) - 1): r["component_id"] for r in out}
    assert len(out) == len(rows)
    assert (of[1, print_of(a)], of[None, print_of(b)], of[2, print_of(c)], of[None, print_of(alone)]) == (1, 1, 1, None)
    kept = simhash.keep_first_row(helpers.docs(spark, rows)).collect()
    assert sorted(map(repr, [(r["doc_id"], r["text"]) for r in kept])) == sorted(map(repr, [(1, a), (3, None), (None, alone), (4, other)]))
    nobody = simhash.keep_first_row(helpers.docs(spark, [(None, a, "en", "a", 1), (None, c, "en", "a", 1), (None, b, "en", "a", 1)]))
    assert nobody.count() == 1
    item = helpers.prose(rng, 30)
    rows = [(None, item, "en", "a", 1), (None, alone, "en", "a", 1), (7, other + " " + item, "en", "a", 1), (7, other, "en", "a", 1)]
    left = decontaminate.without_leaks(helpers.docs(spark, rows), spark.createDataFrame([(1, item)], helpers.ITEMS))
    assert helpers.rows_of(left) == helpers.rows_of(helpers.docs(spark, [rows[1], rows[3]]))


def test_links_of_crowded_fingerprints(spark):
    """Many fingerprints that share blocks, and shards cut again, against all pairs."""
    rng = random.Random(9)
    values = set()
    for _ in range(6):
        center = rng.getrandbits(64)
        values |= {center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
    items = sorted(enumerate(sorted(values)))
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, n) for n, v in items], "fp long, name long")
    for tree_rows in (1000, 5):
        links = simhash.link_fingerprints(nodes, tree_rows=tree_rows)
        pairs = [(r["a"], r["b"]) for r in links.collect()]
        assert all((items[a][1] ^ items[b][1]).bit_count() >= 1 for a, b in pairs)
        found = {r["node"]: r["component"] for r in components.connected_components(links, "a", "b").collect()}
        want = groups(items, lambda a, b: (a ^ b).bit_count() <= 2)
        assert [found.get(n, n) for n, _ in items] == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (7, 7)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.connected_components(edges, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
    assert components.connected_components(edges.where("a < 0"), "a", "b").count() == 0


def test_repeated_lines_by_brute_force(spark):
    session_settings(spark)
    rng = random.Random(4)
    lines = [helpers.prose(rng, rng.randint(1, 30), 99) for _ in range(30)]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 6)) + ["", "  "]), "en", "a", 1) for i in range(1000, 1060)]
    rows += [r for r in helpers.odd_rows() if r[0] not in (None, 2)]
    seen, want = {}, set()
    for doc, text, *_ in sorted(rows, key=lambda r: r[0]):
        for k, (start, end, words) in enumerate(line_dedup.text_units(text or "")):
            assert " ".join(text[start:end].translate({i: i + 32 for i in range(65, 91)}).split()) == b" ".join(words).decode()
            first = seen.setdefault(tuple(words), (doc, k))
            if first != (doc, k):
                want.add((doc, k, start, end, first[0]))
    out = line_dedup.repeated_units(helpers.clash(helpers.docs(spark, rows)), min_run_words=0).collect()
    assert {(r["doc_id"], r["unit"], r["start"], r["end"], r["kept_in"]) for r in out} == want and len(out) == len(want)
    runs = line_dedup.repeated_units(helpers.docs(spark, rows)).collect()
    assert all(r["run_words"] >= line_dedup.MIN_RUN_WORDS for r in runs)
    left = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(helpers.docs(spark, rows), min_run_words=0).collect()}
    cut = {}
    for doc, _, start, end, _ in want:
        cut.setdefault(doc, []).append((start, end))
    for doc, text, *_ in rows:
        spans = cut.get(doc)
        if spans:
            text = "\n".join(part for at, part in _placed(text) if not any(s == at and e == at + len(part) for s, e in spans))
            assert left[doc].rstrip("\n") == text.rstrip("\n")
        else:
            assert left[doc] == text
    assert line_dedup.repeated_units(helpers.docs(spark, [])).count() == 0
    odd = line_dedup.repeated_units(helpers.docs(spark, helpers.odd_rows()), min_run_words=0)
    assert {r["doc_id"] for r in odd.collect()} <= {2, 6}


def test_every_repeated_line_of_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    seen, want = set(), set()
    for r in sorted(spark.read.parquet(f"{folder}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        for k, (start, end, words) in enumerate(line_dedup.text_units(r["text"] or "", "clause")):
            if tuple(words) in seen:
                want.add((r["doc_id"], k, start, end))
            seen.add(tuple(words))
    out = QUERIES["op1_line_dedup_all"](spark, folder).collect()
    assert {(r["doc_id"], r["unit"], r["start"], r["end"]) for r in out} == want and len(out) == len(want)
    assert any(r["run_words"] < line_dedup.MIN_RUN_WORDS for r in out)
    assert sorted(r for r in out if r["run_words"] >= line_dedup.MIN_RUN_WORDS) == sorted(QUERIES["op1_line_dedup"](spark, folder).collect())


def plain_clauses(text):
    """Start, end and words of clauses, character by character."""
    blanks, out, at = " \t\n\x0b\x0c\r", [], 0
    for i in range(1, len(text) + 1):
        if i == len(text) or (text[i - 1] in ".!?,;:" and text[i] in blanks) or text[i - 1:i + 1] == "\n\n":
            part = text[at:i]
            words = [w for w in re.split("[" + blanks + "]+", part.translate({i: i + 32 for i in range(65, 91)})) if w]
            if len(words) >= 4:
                start = at + len(part) - len(part.lstrip(blanks))
                out.append((start, start + len(part.strip(blanks)), [w.encode() for w in words]))
            at = i
    return out


def test_clauses_by_brute_force(spark):
    session_settings(spark)
    rng = random.Random(15)
    passage = helpers.prose(rng, 70, line=9).replace("\n", " ").replace(". ", "; ", 2)
    rows = [r for r in helpers.odd_rows() if r[0] not in (2, None)]
    for i in range(100, 130):
        words = passage.split()
        for k in range(i % 7, len(words), 13):  # each copy has its own line breaks
            words[k] += "\n"
        body = helpers.prose(rng, 40).rstrip(".") + ". " + " ".join(words).replace("\n ", "\n") + "\n\n" + helpers.prose(rng, 30)
        rows.append((i, body, "en", "a", 1))
    for text in [r[1] or "" for r in rows] + ["a, b; c. d: e f g h\n\n\ni j k l . m", "x.y z? 1,2 3 4 5!\tsix seven eight nine", " \n\n "]:
        assert list(line_dedup.text_units(text, "clause")) == plain_clauses(text)
    seen, want = {}, set()
    for doc, text, *_ in sorted(rows, key=lambda r: r[0]):
        for k, (start, end, words) in enumerate(plain_clauses(text or "")):
            if seen.setdefault(tuple(words), (doc, k)) != (doc, k):
                want.add((doc, k, start, end, seen[tuple(words)][0]))
    out = line_dedup.repeated_units(helpers.clash(helpers.docs(spark, rows)), min_run_words=0, unit="clause").collect()
    assert {(r["doc_id"], r["unit"], r["start"], r["end"], r["kept_in"]) for r in out} == want and len(out) == len(want)
    # All copies of the passage but the first are found by their runs, and nothing else is.
    runs = line_dedup.repeated_units(helpers.docs(spark, rows), unit="clause").collect()
    assert {r["doc_id"] for r in runs} == set(range(101, 130))
    left = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(helpers.docs(spark, rows), unit="clause").collect()}
    for doc, text, *_ in rows:
        if doc >= 101:
            assert not set(map(tuple, (u[2] for u in plain_clauses(passage)))) & set(map(tuple, (u[2] for u in plain_clauses(left[doc]))))
        else:
            assert left[doc] == text


def test_rows_that_share_an_id_lose_their_own_units_only(spark):
    session_settings(spark)
    rng = random.Random(16)
    a, b, c = (helpers.prose(rng, 48) for _ in range(3))
    rows = [(1, a, "en", "x", 1), (5, a + "\n" + b, "en", "x", 1), (5, c + "\n" + b, "en", "x", 1), (None, c, "en", "x", 1), (None, c, "en", "x", 1)]
    left = line_dedup.without_repeats(helpers.docs(spark, rows).coalesce(1)).collect()
    # Rank: id 1, the first row of id 5, its second row, then the null ids.
    assert sorted((str(r["doc_id"]), r["text"].strip("\n")) for r in left) == sorted([("1", a), ("5", b), ("5", c), ("None", ""), ("None", "")])


def _placed(text):
    at = 0
    for part in text.split("\n"):
        yield at, part
        at += len(part) + 1


def test_passages_are_found_in_spite_of_replaced_tokens(spark):
    session_settings(spark)
    rng = random.Random(6)
    items = [(i, helpers.prose(rng, rng.randint(20, 60))) for i in range(20)] + [(50, "tiny probe of words"), (51, None), (52, "")]
    rows, leaked = helpers.odd_rows(), set()
    for i in range(60):
        body = helpers.prose(rng, 150).split()
        if i % 3 == 0:
            item = items[i % 20]
            part = item[1].split()
            if i % 2:
                for k in range(5, len(part), 9):
                    part[k] = "replaced"
            body[70:70] = part
            leaked.add((1000 + i, item[0]))
        rows.append((1000 + i, " ".join(body).upper() if i % 4 == 0 else " ".join(body), "en", "a", 1))
    rows.append((2000, "before, tiny -- Probe of words after", "en", "a", 1))
    leaked.add((2000, 50))
    out = decontaminate.overlaps(helpers.clash(helpers.docs(spark, rows)).drop("item_id"), spark.createDataFrame(items, helpers.ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == leaked
    assert all(r["n_equal"] >= min(13, 4) and r["doc_end"] - r["doc_start"] == r["item_end"] - r["item_start"] for r in out)
    left = decontaminate.without_leaks(helpers.docs(spark, rows), spark.createDataFrame(items, helpers.ITEMS))
    assert helpers.rows_of(left) == helpers.rows_of(helpers.docs(spark, [r for r in rows if r[0] not in {d for d, _ in leaked}]))
    none = spark.createDataFrame([], helpers.ITEMS)
    assert decontaminate.overlaps(helpers.docs(spark, rows), none).count() == 0
    assert decontaminate.overlaps(helpers.docs(spark, []), spark.createDataFrame(items, helpers.ITEMS)).count() == 0


def test_every_fourth_token_replaced(spark):
    """Wherever the replaced tokens start, some mask passes over all of them."""
    session_settings(spark)
    rng = random.Random(17)
    items = [(i, helpers.prose(rng, rng.randint(40, 60))) for i in range(8)]
    rows = []
    for i in range(8):
        part = items[i][1].split()
        part[i % 4::4] = ["other"] * len(part[i % 4::4])
        rows.append((100 + i, helpers.prose(rng, 50) + " " + " ".join(part) + " " + helpers.prose(rng, 50), "en", "a", 1))
    out = decontaminate.overlaps(helpers.docs(spark, rows), spark.createDataFrame(items, helpers.ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == {(100 + i, i) for i in range(8)}


def test_given_tables_against_all_windows(spark):
    """Every document that shares thirteen tokens in a row with an item is found, and no other."""
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    tokens = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = {}
    for r in items.collect():
        w = tokens(r["text"])
        for k in range(len(w) - 12):
            grams.setdefault(tuple(w[k:k + 13]), set()).add(r["item_id"])
    want = set()
    for r in docs.collect():
        w = tokens(r["text"])
        want |= {(r["doc_id"], i) for k in range(len(w) - 12) for i in grams.get(tuple(w[k:k + 13]), ())}
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, items).collect()} == want
