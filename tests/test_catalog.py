"""Every registered query runs and equals its expected result."""

import pytest

from loomledger.testbed.catalog import load

CATALOG = load()


def normalised(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(row[i] + 0.0 if isinstance(row[i], float) else row[i] for i in order) for row in rows]
    return sorted(plain, key=repr)


@pytest.mark.parametrize("name", CATALOG)
def test_query(name, spark, duck, sf_dir):
    df = CATALOG[name].build(spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    if CATALOG[name].sql is None:
        assert rows
        return
    cursor = duck.execute(CATALOG[name].sql)
    expected_names = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(expected_names)
    assert normalised(df.columns, rows) == normalised(expected_names, cursor.fetchall())


def test_every_query_has_an_expected_result():
    assert not [name for name, query in CATALOG.items() if query.sql is None]
