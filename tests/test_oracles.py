"""Every registered query against its SQL on whole tables."""

import oracle
import pytest

from sitegauge.plans.oracles import ORACLES
from sitegauge.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, SF), con, ORACLES[name]) == ""


@pytest.mark.parametrize(
    "name", ["embedded_json_extract", "own_history", "duration_to_seconds", "relative_ranking"]
)
def test_session_settings_do_not_matter(spark, con, conf, name):
    conf("spark.sql.session.timeZone", "America/Los_Angeles")
    conf("spark.sql.ansi.enabled", "false")
    conf("spark.sql.adaptive.enabled", "false")
    assert oracle.difference(QUERIES[name](spark, SF), con, ORACLES[name]) == ""
