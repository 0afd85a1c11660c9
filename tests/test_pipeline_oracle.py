"""The zone pipeline end to end (Parquet written and read back between
stages) against the SQL oracle, on Bronze derived from the sf0.001 tables."""

import tempfile

import pytest

import __spark_entry__ as entry
from marlstone.plans.pipeline import bronze_to_silver, silver_to_gold
from marlstone.schemas import BRONZE_TO_SILVER, GOLD
from marlstone.sources.testdata import bronze_tables
from marlstone.sources.zones import read_table, write_table
from tests.conftest import SF_SMALL
from tests.oracle_check import duck, rows_of_duck, rows_of_spark


@pytest.fixture(scope="module")
def lake(spark, scratch):
    root = tempfile.mkdtemp(prefix="oracle-lake-", dir=scratch)
    for table, df in bronze_tables(spark, SF_SMALL).items():
        write_table(df, root, "bronze", table)
    silver = bronze_to_silver(spark, root)
    gold = silver_to_gold(spark, root)
    return {"root": root, "silver": silver, "gold": gold}


CASES = [("silver", t, f"silver_{t}") for t in BRONZE_TO_SILVER.values()] + [
    ("gold", t, t) for t in GOLD]


@pytest.mark.parametrize("zone,table,query", CASES)
def test_written_table_matches_oracle(spark, lake, zone, table, query):
    df = read_table(spark, lake["root"], zone, table)
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows, _ = rows_of_duck(duck(SF_SMALL), entry.oracle_sql()[query])
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_reported_counts_match_files(spark, lake):
    for res in lake["silver"] + lake["gold"]:
        assert spark.read.parquet(res.path).count() == res.row_count, res.table
