import pytest

from tests.compare import difference, views
from tidemark.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), views(SF_DIR), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_every_row_comes_back(spark, name):
    table = "pages" if name.startswith(("op3_", "op7_")) else "documents"
    rows = QUERIES[name](spark, SF_DIR)
    # packing gives a row for each piece of a document
    rows = rows.where("piece = 0") if name.startswith("op12_") else rows
    assert rows.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
