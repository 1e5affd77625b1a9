"""Registered queries against their SQL, and those without against brute force over the same table."""

import os
import zlib

import duckdb
import pytest

import __spark_entry__
from paysieve.llm import queries
from paysieve.llm.simhash import fingerprint
from tests.llm.test_simhash import components

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    found = __spark_entry__.queries()
    assert [f"op{n}" for n in range(1, 14)] == [q.split("_")[0] for q in sorted(queries.QUERIES, key=lambda q: int(q[2:].split("_")[0]))]
    assert "pipeline" in found and set(queries.ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_agrees(spark, name):
    database = duckdb.connect()
    for table in ("documents", "embeddings"):
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = queries.QUERIES[name](spark, SF)
    want = database.sql(queries.ORACLES[name])
    columns = sorted(found.columns)
    assert columns == sorted(want.columns)
    order = ", ".join(f'"{c}"' for c in columns)
    assert sorted(map(repr, map(tuple, found.select(columns).collect()))) == sorted(map(repr, want.project(order).fetchall()))


def test_simhash_of_the_whole_table(spark):
    docs = [(r.doc_id, fingerprint(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    groups = {v: g for g in components(sorted({v for _, v in docs})) for v in g}
    want = {d: (f"{v:016x}", min(i for i, w in docs if w in set(groups[v]))) for d, v in docs}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash(spark, SF).collect()} == want


def test_packing_of_the_whole_table(spark):
    found = queries.op2_packing(spark, SF).collect()
    docs = {}
    for r in found:
        docs.setdefault(r.doc_id, []).append(r)
    assert set(docs) == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    for pieces in docs.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == pieces[0].doc_tokens


def test_held_out_marks(spark):
    for name, modulus, remainder in (("op3_language", 3, 1), ("op10_lm", 10, 0)):
        for r in queries.QUERIES[name](spark, SF).collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == remainder)


def test_entry_works_without_this_part(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    shutil.copytree(root / "paysieve", tmp_path / "paysieve", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q) and 'pipeline' not in q; e.oracle_sql()"
    environment = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, check=True, timeout=120)
