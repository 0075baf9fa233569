"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences
from checks.oracle import ORACLE
from checks.queries import REGISTRY


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, connection, sf_dir, name):
    assert differences(spark, connection, sf_dir, name) == []


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(contract.queries()) >= set(contract.oracle_sql()) >= set(ORACLE)


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["pos", "ticket_id", "reason"]
    assert rows.count() == 200


# rows, clean, rejected, repaired and rows per code of the ticket view, worked out beforehand
ANCHORS = {
    "sf0.001": ((200, 163, 37, 10), (7, 5, 9, 5, 5, 7, 19, 3)),
    "sf0.01": ((1000, 809, 191, 44), (35, 24, 44, 25, 27, 33, 94, 16)),
    "sf0.1": ((10000, 8151, 1849, 423), (345, 233, 435, 244, 264, 323, 939, 164)),
}
CODES = [
    "bad:channel", "bad:sentiment", "bad:range:priority", "bad:timestamp",
    "bad:updated_at<created_at", "bad:category_not_allowed", "bad:priority_rule",
]


@pytest.mark.parametrize("sf", ANCHORS)
def test_anchor_numbers(spark, sf):
    registered = contract.queries()
    folder = f"/root/testdata/{sf}"
    summary, codes = ANCHORS[sf]
    assert tuple(registered["run_summary"](spark, folder).first()) == summary
    counted = {r.code: r.n for r in registered["validate_codes"](spark, folder).collect()}
    assert counted == dict(zip(CODES, codes))
    assert registered["duplicate_ids"](spark, folder).count() == codes[-1]
