"""Token files: round trip against the tokenizer, encodings, row groups and pages, selective reads."""

import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contractflow.llm import token_files as W
from contractflow.llm.base import settings as session_settings
from contractflow.llm.packing import tokenizer_path

import helpers


def expected(rows):
    """Rows by id (nulls first), texts of one id in any order, with the tokenizer's ids and the end id."""
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return {(r[0], r[1]): tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows}


def many(n=400, seed=1):
    rng = random.Random(seed)
    return [(i, helpers.prose(rng, rng.randint(1, 120)), "en", "a", 1) for i in range(1000, 1000 + n)]


def test_round_trip_with_odd_rows(spark, tmp_path):
    session_settings(spark)
    rows = helpers.odd_rows() + many(100)
    random.Random(2).shuffle(rows)
    W.write_tokens(helpers.clash(helpers.docs(spark, rows)), str(tmp_path / "f"), file_bytes=20_000)
    back = W.read_tokens(spark, str(tmp_path / "f")).orderBy("start").collect()
    assert len(list((tmp_path / "f" / "tokens").glob("*.parquet"))) > 5
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in back]
    assert keys == sorted(keys)
    starts = np.cumsum([0, *[r["n_tokens"] for r in back]])
    assert [r["start"] for r in back] == starts[:-1].tolist()
    want = expected(rows)
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in back) == sorted((r[0] or -1, want[r[0], r[1]]) for r in rows)
    digests = {r["start"]: r["ids_crc32"] for r in W.digests(W.read_tokens(spark, str(tmp_path / "f"))).collect()}
    assert digests == {r["start"]: zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in back}


def test_query(spark, tmp_path):
    session_settings(spark)
    rows = many(150)
    helpers.docs(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    want, start, out = expected(rows), 0, []
    for r in rows:
        ids = want[r[0], r[1]]
        out.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert helpers.rows_of(W.op12(spark, str(tmp_path))) == sorted(out, key=repr)


def test_encodings_row_groups_and_page_indexes(spark, tmp_path):
    session_settings(spark)
    W.write_tokens(helpers.docs(spark, many(3000)), str(tmp_path / "f"), group_bytes=200_000, page_rows=50)
    (file,) = (tmp_path / "f" / "tokens").glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups > 2
    for g in range(meta.num_row_groups):
        columns = {c.path_in_schema: c for c in map(meta.row_group(g).column, range(meta.num_columns))}
        assert "DELTA_BINARY_PACKED" in columns["position"].encodings
        (ids,) = [c for name, c in columns.items() if name.startswith("ids.")]
        assert "RLE_DICTIONARY" in ids.encodings and ids.total_compressed_size < 4 * ids.num_values
        for c in columns.values():
            assert c.has_offset_index and c.has_column_index


def test_selective_reads(spark, tmp_path):
    session_settings(spark)
    rows = many(300) + [(5, None, "en", "a", 1)]
    folder = str(tmp_path / "f")
    W.write_tokens(helpers.docs(spark, rows), folder, file_bytes=15_000, page_rows=10)
    want, whole, starts = expected(rows), [], {}
    for r in sorted(rows, key=lambda r: r[0]):
        starts[r[0]] = len(whole)
        whole += want[r[0], r[1]]
    index = W.read_index(spark, folder)
    assert "ids" not in index._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert {r["doc_id"]: r["start"] for r in index.collect()} == starts
    some = W.read_tokens(spark, folder, F.col("doc_id").isin(1003, 1150))
    assert "In(doc_id" in some._jdf.queryExecution().executedPlan().toString()
    assert {(r["doc_id"], r["start"]) for r in some.collect()} == {(1003, starts[1003]), (1150, starts[1150])}
    rng = random.Random(4)
    spans = [(0, len(whole)), (0, 1), (7, 7), (len(whole) - 1, len(whole) + 50), (len(whole), len(whole) + 1)]
    spans += [tuple(sorted(rng.sample(range(len(whole)), 2))) for _ in range(6)]
    for a, b in spans:
        found = W.read_span(spark, folder, a, b).orderBy("start").collect()
        assert [x for r in found for x in r["ids"]] == whole[a:b]
        assert not found or found[0]["start"] == a


def test_hot_id_is_spread_and_empty_table(spark, tmp_path):
    session_settings(spark)
    rows = [(7, r[1], "en", "a", 1) for r in many(200)] + [(7, "same text here", "en", "a", 1)] * 400 + many(50)
    W.write_tokens(helpers.docs(spark, rows), str(tmp_path / "f"), file_bytes=4_000)
    per_file = W.stored(spark, str(tmp_path / "f")).groupBy("part").count().collect()
    assert len(per_file) > 10 and max(r["count"] for r in per_file) < 0.5 * len(rows)
    W.write_tokens(helpers.docs(spark, []), str(tmp_path / "e"))
    assert W.read_tokens(spark, str(tmp_path / "e")).count() == 0 and W.read_span(spark, str(tmp_path / "e"), 0, 9).count() == 0
    assert Path(tmp_path / "e" / "parts").exists()
