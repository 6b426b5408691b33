"""Every registered query runs over the smallest tables: its columns, their types, and what has a row."""

from __future__ import annotations

from collections import Counter

import pytest

from geohealth.llm import queries

SF = "/root/testdata/sf0.001"
HEAD = "doc_id bigint, held_out boolean, "
COLUMNS = {
    1: "query_id bigint, rank int, vec_id bigint, score double",
    2: HEAD + "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    3: "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    4: "doc_id bigint, fingerprint string, component_id bigint",
    5: HEAD + "score double, predicted int",
    6: HEAD + "score double, predicted int",
    7: "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    8: "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    9: "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    10: HEAD + "lang_pred string, score double",
    11: "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    12: "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    13: "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
}


@pytest.fixture(scope="module")
def ids(spark):
    return Counter(r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_columns_and_rows(spark, ids, number):
    name = next(n for n in queries.QUERIES if n.startswith(f"op{number}_"))
    got = queries.QUERIES[name](spark, SF)
    want = COLUMNS[number].split(", ")
    assert [f"{c} {t}" for c, t in got.dtypes][: len(want)] == want
    rows = got.collect()
    assert not any(v is None for r in rows for c, v in r.asDict().items() if c not in ("grown_shard", "deviation") and f"{c} " in COLUMNS[number])
    if number in (2, 3, 4, 5, 6, 8, 9, 10):
        assert Counter(r.doc_id for r in rows) == ids
    elif number in (7, 11):
        assert {r.doc_id for r in rows} == set(ids)
    elif number == 1:
        asked = {r[0] for r in spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 20 = 0").select("vec_id").collect()}
        assert {r.query_id for r in rows} == asked and Counter(r["rank"] for r in rows) == {k: len(asked) for k in range(1, 21)}
    elif number == 12:
        vectors = Counter(r[0] for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id").collect())
        assert Counter(r.vec_id for r in rows) == {i: 16 * n for i, n in vectors.items()} and rows[0].identity_error < 1e-4
    else:
        assert all(r.a >= 10 and r.l >= r.a and r.r >= r.a for r in rows)


def test_all_are_here():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in sorted(COLUMNS)]
