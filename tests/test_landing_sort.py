"""Landed rows are sorted by their folder while they are narrow, not as whole records by the write."""
import pytest

from clipstar.plans import adapters
from clipstar.sources.landing import by_day
from tests.helpers import event, events_df

SF = "/root/testdata/sf0.001"


def _ordering(df) -> str:
    """What a write into folders asks of its rows: if they come in this order, it does not sort them itself."""
    return df._jdf.queryExecution().optimizedPlan().outputOrdering().mkString(",")


@pytest.mark.parametrize("landed", [adapters.landed_snapshots, adapters.landed_events])
def test_rows_are_sorted_by_folder_before_the_record_is_built(spark, landed):
    df = landed(spark, SF, placed=True)
    assert _ordering(df).startswith("load_date#")
    assert df.count() == landed(spark, SF).count()


def test_rows_by_day_come_sorted(spark):
    assert _ordering(by_day(events_df(spark, [event("a", "2025-03-02T01:00:00.000Z", "v", 0.1)]))).startswith("load_date#")
