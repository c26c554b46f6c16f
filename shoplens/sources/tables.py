"""The driver's star-schema tables seen as behaviour events.

One SQL text serves Spark and the SQL checks; only three date and cast spellings differ.
A shopper is a customer in one order year, so short histories exist without leaving
any row out, and order days become hours so that a decay over weeks stays visible.
"""

EVENTS_SQL = """
SELECT {ts} AS timestamp,
  CASE concat(l_returnflag, l_linestatus)
    WHEN 'AF' THEN 'purchase' WHEN 'AO' THEN 'cart' WHEN 'RF' THEN 'remove_from_cart' ELSE 'view' END AS event_type,
  CAST(l_partkey AS INT) AS item_id,
  CAST(2053013550000000000 + p_size AS BIGINT) AS category_id,
  CASE WHEN l_partkey % 10 < 3 THEN NULL
       WHEN p_size % 2 = 0 THEN concat(lower(p_type), '.', split_part(p_name, ' ', 2), '.', split_part(p_name, ' ', 1))
       ELSE concat(lower(p_type), '.', split_part(p_name, ' ', 2)) END AS category_code,
  CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE p_brand END AS brand,
  l_extendedprice / l_quantity AS price,
  CAST(o_custkey * 10 + (year(o_orderdate) - 1995) AS INT) AS user_id,
  md5(CAST(l_orderkey AS {text})) AS session_id
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
"""

_SPARK = {
    "ts": "TIMESTAMP '2019-10-01 00:00:00' + make_dt_interval(0, datediff(o_orderdate, DATE '1995-01-01'), l_linenumber, 0)",
    "text": "STRING",
}
DUCKDB_EVENTS = EVENTS_SQL.format(
    ts="TIMESTAMP '2019-10-01 00:00:00' + to_hours(date_diff('day', TIMESTAMP '1995-01-01 00:00:00', o_orderdate))"
       " + to_minutes(l_linenumber)",
    text="VARCHAR", lineitem="lineitem", orders="orders", part="part")


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def behaviour_events(spark, folder):
    """The event contract over lineitem, orders and part."""
    names = ("lineitem", "orders", "part")
    return spark.sql(EVENTS_SQL.format(**_SPARK, **{n: "{" + n + "}" for n in names}),
                     **{n: table(spark, folder, n) for n in names})
