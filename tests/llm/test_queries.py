"""Every registered query of the subpackage, called once as it is: columns, types, rows."""

from __future__ import annotations

import pytest

from quartermet.llm import queries
from tests.conftest import SF_SMALL

# Query: its table, the table's key, and the columns it must have.
WANT = {
    "op1": ("documents", "doc_id", "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"),
    "op2": ("documents", "doc_id", "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
            "contaminated boolean"),
    "op3": ("documents", "doc_id", "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
            "sequence_id bigint, offset bigint"),
    "op4": ("documents", "doc_id", "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
            "base_sha256 string, spans string"),
    "op5": ("pages", "page_id", "page_id bigint, url string, text string, n_chars bigint"),
    "op6": ("embeddings", "vec_id", "vec_id bigint, n_links bigint, component_id bigint, kept boolean"),
    "op7": ("documents", "doc_id", "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"),
    "op8": ("documents", "doc_id", "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean"),
    "op9": ("documents", "doc_id", "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"),
    "op10": ("documents", "doc_id", "doc_id bigint, held_out boolean, score double, predicted int"),
    "op11": ("documents", "doc_id", "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
             "folded_root string, verified boolean"),
    "op12": ("documents", "doc_id", "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
             "spans string"),
    "op13": ("documents", "doc_id", "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
             "count_sum bigint, groups_sha256 string"),
}


def test_all_are_there():
    assert sorted(name.split("_")[0] for name in queries.QUERIES) == sorted(WANT)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    table, key, columns = WANT[name.split("_")[0]]
    out = queries.QUERIES[name](spark, SF_SMALL)
    kinds = dict(out.dtypes)
    for column in columns.split(", "):
        have, kind = column.split(" ")
        # Numbers of the tables keep the tables' own type.
        assert kinds[have] == kind or (have == key and kinds[have] in ("int", "bigint")), (column, kinds[have])
    rows = out.collect()
    ids = [r[0] for r in spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(key).collect()]
    if name.startswith("op3"):
        rows = [r for r in rows if r.piece == 0]
    assert sorted(r[key] for r in rows) == sorted(ids)
    if name.startswith("op1_"):
        rows.sort(key=lambda r: r.doc_id)
        assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    if name.startswith("op6"):
        assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    if name.startswith("op8"):
        assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    if name.startswith("op10"):
        assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    if name.startswith("op11"):
        assert len({r.root for r in rows}) == 1 and any(not r.verified for r in rows)
        assert all(r.verified == (r.folded_root == r.root) for r in rows)
