"""Publishing the churn table, and bridges that read it."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from revbridge.plans.bridge import BridgePlan
from revbridge.sources.churn_store import ChurnStore, PublishError, StaleSource
from revbridge.sources.tpch_binding import fixture_policy, ledger_for

DAY = dt.datetime(2026, 1, 31)
SCHEMA = (
    "entity_id long, entity_type string, user_ids long, pickup_date timestamp_ntz, payment_date timestamp_ntz, transaction_type string, churn_flag string, "
    "start_date timestamp_ntz, end_date timestamp_ntz, taxable_amount decimal(18,2), rnk int, refreshed_at timestamp_ntz"
)


def row(i, flag="FULL", at=DAY, **other):
    base = dict(entity_id=i, entity_type="ITEM", user_ids=1, pickup_date=DAY, payment_date=DAY, transaction_type="return_item", churn_flag=flag,
                start_date=DAY, end_date=DAY, taxable_amount=Decimal("1.00"), rnk=1, refreshed_at=at)
    return tuple({**base, **other}.values())


@pytest.fixture()
def store(tmp_path):
    return ChurnStore(str(tmp_path / "churn"))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def ids(df):
    return sorted(r.entity_id for r in df.collect())


def test_readers_see_the_newest_whole_publication(spark, store):
    assert store.publish(frame(spark, row(1), row(2))) == 1
    old = store.read(spark, refreshed_at=DAY.date())
    assert store.publish(frame(spark, row(3))) == 2
    assert ids(store.read(spark)) == [3] and ids(old) == [1, 2] and ids(store.read(spark, version=1)) == [1, 2]
    assert store.marker(spark, 2)["rows"] == 1
    store.keep(spark, 1)
    assert store.versions(spark) == [2] and ids(store.read(spark)) == [3]
    with pytest.raises(StaleSource):
        store.read(spark, version=1)


@pytest.mark.parametrize("bad", [
    row(None), row(5, flag="ACTIVE"), row(5, entity_type="CAR"), row(5, rnk=0), row(5, at=None), row(5, at=dt.datetime(2026, 1, 30)),
])
def test_a_failed_publication_leaves_the_old_one(spark, store, bad):
    store.publish(frame(spark, row(1)))
    with pytest.raises(PublishError):
        store.publish(frame(spark, row(2), bad))
    assert store.versions(spark) == [1] and ids(store.read(spark)) == [1]
    data = store._fs(spark)[0].listStatus(store._fs(spark)[1](f"{store.root}/data"))
    assert len(data) == 1  # its rows are gone too


def test_too_few_rows_other_columns_and_lost_races(spark, store):
    with pytest.raises(PublishError, match="of at least 3"):
        store.publish(frame(spark, row(1)), least_rows=3)
    with pytest.raises(PublishError, match="rnk"):
        store.publish(frame(spark, row(1)).drop("rnk"))
    store.publish(frame(spark, row(1)))
    store.versions = lambda spark: []  # another run has taken the number meanwhile
    with pytest.raises(PublishError, match="another run"):
        store.publish(frame(spark, row(2)))
    del store.versions
    assert ids(store.read(spark)) == [1]


def test_unpublished_and_outdated_tables_are_errors(spark, store):
    with pytest.raises(StaleSource, match="nothing"):
        store.read(spark)
    store.publish(frame(spark, row(1)))
    with pytest.raises(StaleSource, match="wanted 2026-02-28"):
        store.read(spark, refreshed_at=dt.date(2026, 2, 28))


def test_a_bridge_on_a_published_table_equals_the_recomputed_one(spark, store):
    ledger, policy = ledger_for(spark, "/root/testdata/sf0.001"), fixture_policy()
    with BridgePlan(spark, ledger, policy) as own:
        want = sorted(map(tuple, own.churn_events.collect()))
        store.publish(own.churn_table)
    with BridgePlan(spark, ledger, policy, churn_source=store) as plan:
        assert sorted(map(tuple, plan.churn_events.collect())) == want and want
        assert "churn" not in plan.__dict__  # nothing of churn was rebuilt
        assert plan.rows("R06").filter(F.col("component") == "R06").count() > 0
