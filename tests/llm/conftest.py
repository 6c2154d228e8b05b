"""Small tables for the operators' edge cases."""

import duckdb
import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture()
def documents(spark):
    """Makes documents of (doc_id, text[, lang[, source]]) rows; the rest stays null."""

    def make(rows, schema=DOCUMENTS):
        return spark.createDataFrame([(*row, None, None, None)[:5] for row in rows], schema)

    return make


@pytest.fixture(scope="session")
def given(spark):
    """(doc_id, text) of the smallest documents."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    return {row.doc_id: row.text for row in rows}


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in "documents benchmark labels conversations embeddings".split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.fixture()
def same_as_sql(spark):
    """Holds a query's rows over hand-made tables against its SQL over the same tables."""
    from tallymark.llm import oracles

    def check(name, found, **tables):
        connection = duckdb.connect()
        for table, frame in tables.items():
            arrow = frame.toArrow()  # noqa: F841
            connection.execute(f"CREATE TABLE {table} AS SELECT * FROM arrow")
        cursor = connection.execute(oracles.ORACLES[name])
        names = [column[0] for column in cursor.description]
        assert sorted(names) == sorted(found.columns)
        expected = [tuple(row[names.index(c)] for c in found.columns) for row in cursor.fetchall()]
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)

    return check
