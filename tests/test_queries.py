import os

import duckdb
import pytest

from shiftloom import queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return "" if v is None else repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "kmeans_assign"])
def test_query_equals_its_sql(spark, con, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in queries.ORACLE_SQL:
        assert got
        return
    r = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in r.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(x[names.index(c)]) for c in columns) for x in r.fetchall())


def test_payloads_without_a_shift_are_null_as_in_sql(spark, tmp_path):
    rows = [(1, 3, 5.0), (2, 3, 7.0), (3, 1, 9.0), (3, 2, 4.0), (3, 3, 1.0)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {(r.k, r.shifts, r.kind) for r in queries.QUERIES["spectrum_payloads"](spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert got == set(c.execute(queries.ORACLE_SQL["spectrum_payloads"]).fetchall()) == {(1, None, "CHF"), (2, None, "F"), (3, "4.0|9.0", "H")}


def test_peaks_of_equal_keys_stay_in_the_order_of_the_file(spark, tmp_path):
    rows = [(1, 4, 7, 8, q, "N") for q in (43.0, 19.0, 30.0, 5.0)] + [(2, 2, 1, 1, q, f) for q, f in ((9.0, "R"), (8.0, "A"))]
    kind = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string"
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {(r.k, r.protons, r.carbons) for r in queries.QUERIES["normal_peaks"](spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert got == set(c.execute(queries.ORACLE_SQL["normal_peaks"]).fetchall()) == {(1, "43.0:N|19.0:N|30.0:N|5.0:N", 4), (2, "9.0:R|8.0:A", 2)}


def test_hits_with_letters_of_two_capitals_as_in_sql(spark, tmp_path):
    said = ["Straße und mehr", "Straße und Meer", "ﬁn de siècle", "ŉ boom", "plain text", "σας λέω", "", None]
    rows = [(i, turn, "user", text) for i, text in enumerate(said) for turn in (0, 1)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(tuple(r) for r in queries.QUERIES["distinct_hits"](spark, str(tmp_path)).collect())
    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == sorted(c.execute(queries.ORACLE_SQL["distinct_hits"]).fetchall()) and len(got) == 7


def test_reasons_read_the_whole_text(spark, tmp_path):
    rows = [(1, " " * 40 + "late words"), (2, "nan" + " " * 40 + "words"), (3, " " * 60), (4, "\n" * 45 + "x"), (5, "plain")]
    spark.createDataFrame([(i, t, "en", "a") for i, t in rows], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.reason: r.n for r in queries.drop_reasons(spark, str(tmp_path)).collect()} == {"empty": 1, "kept": 4}
    whole = queries.ingest_summary(spark, str(tmp_path)).where("source IS NULL AND lang IS NULL").first()
    assert (whole.n_rows, whole.kept, whole.dropped_empty) == (5, 4, 1)


def test_entry_and_registry_without_the_llm_folder(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "shiftloom"), tmp_path / "shiftloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'balanced_sample' in q and not any(n.startswith('op') for n in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
