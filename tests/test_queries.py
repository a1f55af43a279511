"""Every query of the panel library against its SQL; others must give rows."""

import pytest
from compare import connect, difference, spark_rows, sql_rows

from panelweave.queries import ORACLES, QUERIES

#: At this scale every series is observed in few periods, a target that ten suppliers share with a predictor misses
#: nothing, and three users share no two indicators on ten days.
EMPTY = {"series_screen", "year_by_year_linear", "year_by_year_multi", "time_series_model", "time_series_linear", "time_series_performance"}
NO_ROWS = {"model_elastic_net", "time_series", "time_series_importances"}


@pytest.fixture(scope="module")
def tables(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, tables, name):
    found = QUERIES[name](spark, sf)
    if name in EMPTY:
        assert spark_rows(found) == sql_rows(tables, ORACLES[name])
    elif name in ORACLES:
        assert difference(found, tables, ORACLES[name]) is None
    else:
        assert found.count() or name in NO_ROWS


def test_entry(spark):
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count()
