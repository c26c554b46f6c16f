"""Small event tables for tests; a module of its own, since every test folder may have a conftest."""

from datetime import datetime, timedelta

EVENT_DDL = ("timestamp timestamp, event_type string, item_id int, category_id bigint, category_code string, "
             "brand string, price double, user_id int, session_id string")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def make_events(spark, tuples):
    """(minute, type, item, code, brand, price, user, session) -> contract events."""
    start = datetime(2020, 1, 1)
    return spark.createDataFrame([
        (start + timedelta(minutes=m), t, i, 100 + i, code, brand, price, u, s)
        for m, t, i, code, brand, price, u, s in tuples], EVENT_DDL)
