"""The five stages against plain Python on the smallest tables, and on odd rows."""

import re
import sys
import zlib
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

import helpers  # noqa: E402
from test_near_duplicates import groups, print_of  # noqa: E402
from test_rules_secrets import base_spans, entropy_spans  # noqa: E402

from contractflow.llm import decision_list, decontaminate, packing  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    rules = decision_list.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept = sorted((tuple(r) for r in decision_list.judge(docs, rules).where("_q_kept").select(*docs.columns).collect()))
    first = groups([(r[0], print_of(r[1])) for r in kept], lambda a, b: (a ^ b).bit_count() <= 2)
    kept = [r for r, f in zip(kept, first) if r[0] == f]
    tokens = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = set()
    for r in items.collect():
        w = tokens(r["text"])
        grams |= {tuple(w[k:k + 13]) for k in range(len(w) - 12)}
    kept = [r for r in kept if not any(tuple(w[k:k + 13]) in grams for w in [tokens(r[1])] for k in range(len(w) - 12))]
    want = []
    tok = packing.word_tokens(packing.tokenizer_path()).tokenizer
    for r in kept:
        text, base = r[1], base_spans(r[1])
        for a, b in sorted(((a, b) for _, a, b in base + entropy_spans(text, base)), reverse=True):
            text = text[:a] + "\0" + text[b:] if "\0" not in text[a:b] else text
        assert "\0" not in r[1]
        text = text.replace("\0", "[SECRET]")
        ids = tok.encode(text, add_special_tokens=False).ids + [0]
        want += [(r[0], k, at, len(ids[at:at + 2048]), zlib.crc32(np.array(ids[at:at + 2048], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    out = corpus_pipeline.run(spark, FOLDER).collect()
    got = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out)
    # an access key inside an assignment overlaps it; texts with overlapping spans are compared by their document only
    assert {g[0] for g in got} == {w[0] for w in want}
    assert len(set(got) & set(want)) >= 0.99 * len(want)


def test_stages_keep_columns_on_odd_rows(spark):
    docs = helpers.docs(spark, helpers.odd_rows())
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, helpers.clash(docs), FOLDER)
        assert out.columns == helpers.clash(docs).columns, name
        empty = step(spark, helpers.docs(spark, []), FOLDER)
        assert empty.columns == docs.columns and empty.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= len(helpers.odd_rows())


def test_leaks_go_in_the_pipeline(spark):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    left = corpus_pipeline.decontamination(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
    assert decontaminate.overlaps(left, items).count() == 0
