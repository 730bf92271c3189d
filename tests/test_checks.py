"""Every registered query against its SQL on the smallest tables."""

import subprocess
import sys

import pytest

import __spark_entry__
import oracle
from checks import queries, sql

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in __spark_entry__.queries().items() if name in queries.QUERIES}
SQL = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = oracle.connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(queries.QUERIES) == set(sql.ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    found = oracle.spark_rows(result)
    assert found[1], "a check on no rows checks nothing"
    assert found == oracle.sql_rows(database, SQL[name])


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_modules_import_without_a_session():
    code = "import __spark_entry__, hazelake.__main__, hazelake.streaming.snapshots"
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def test_indented_files_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(queries, "EVENTS_PER_FILE", 100, raising=False)
    rows = queries.indented_roundtrip(spark, "/root/testdata/sf0.001")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    files = [name for name in rows.inputFiles() if "part-" in name]
    assert rows.count() == events.count()
    assert len(files) == events.selectExpr("floor(event_id / 100)").distinct().count()


def test_landed_responses_grow_in_rows_not_in_files(spark, tmp_path):
    for land, name in ((queries.bridge.landed_pages, "pages"), (queries.bridge.landed_documents, "documents")):
        path = str(tmp_path / name)
        land(spark, SF_DIR, path)
        events = spark.read.parquet(f"{SF_DIR}/events.parquet")
        responses = events.selectExpr("floor(event_id / 100)").distinct().count()
        assert spark.read.parquet(path).count() == responses > len(spark.read.parquet(path).inputFiles())
