"""Every query of the catalog against its oracle."""

import pytest

from scrollspark.plans import catalog
from tests.conftest import rows_of, rows_of_sql


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_has_the_oracles_rows(spark, duck, data, name):
    df = catalog.QUERIES[name](spark, data)
    found = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert rows_of(df) == rows_of_sql(duck, catalog.ORACLE_SQL[name])


def test_every_oracle_belongs_to_a_query():
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_json_scrub_drops_images_and_keeps_the_rest(spark, data):
    import json

    for row in catalog.QUERIES["json_scrub"](spark, data).limit(5).collect():
        document = json.loads(row["document"])
        assert document["layout"] == {"page_index": row["turn"]}
