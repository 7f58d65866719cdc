"""Registered queries against their oracles on the smallest test tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

SAMPLE = (
    "src_6_canonical_json",
    "src_7_bronze_rows",
    "prf_4_field_coverage",
    "ext_19_dosage_summary",
    "num_1_number_text",
    "slv_1_patient",
    "slv_6_medication_ingredient",
    "slv_7_medication_request",
    "rel_3_orphans",
    "prv_5_column_scan",
    "prv_5_encounter_order",
    "gld_1_encounter_summary",
    "gld_3_vitals_daily",
    "gld_7_medication_order_fulfillment",
    "mrt_9_labs_trend",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'"
        )
    return connection


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if value is None:
            return "\0"
        return repr(round(value, 9)) if isinstance(value, float) else str(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    import __spark_entry__ as entry
    from wardlake.harness.queries import QUERIES

    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_query(spark):
    import __spark_entry__ as entry

    result = entry.entry(spark)
    assert result.count() > 0
    assert "condition_row_count" in result.columns


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as entry

    result = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    found = comparable([tuple(r) for r in result.collect()], result.columns)
    assert found == comparable(cursor.fetchall(), columns)
