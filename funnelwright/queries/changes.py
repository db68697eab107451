"""Table changes as rows: insert-new, updates, upserts, range replacement, conformance.

Target and incoming rows are two overlapping date ranges that together cover the table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import latest_per_key
from ..operators.merge import (
    conform,
    insert_new,
    replace_range,
    update_changed,
    upsert,
    upsert_partial,
)
from ..operators.reshape import union_all
from ..schemas import TableSpec
from ..session import scratch_path
from ..sinks import exchange, tables
from .registry import Tables, query

TARGET_END = "1999-01-01"
SOURCE_START = "1998-07-01"


def _orders(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Stored orders and incoming ones with a raised price; the overlap is half a year."""
    rows = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("id_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        "o_orderdate",
    )
    target = rows.where(F.col("o_orderdate") < F.lit(TARGET_END).cast("timestamp_ntz")).drop("o_orderdate")
    source = rows.where(F.col("o_orderdate") >= F.lit(SOURCE_START).cast("timestamp_ntz")).drop("o_orderdate")
    return target, source.withColumn("price", F.round(F.col("price") + 1000, 2))


ORDERS_SQL = f"""o AS (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m%d') AS id_date, o_orderstatus AS status,
    o_totalprice AS price, o_orderdate AS d FROM orders),
  tgt AS (SELECT id, id_date, status, price FROM o WHERE d < TIMESTAMP '{TARGET_END}'),
  src AS (SELECT id, id_date, status, round(price + 1000, 2) AS price FROM o WHERE d >= TIMESTAMP '{SOURCE_START}')"""


@query(f"WITH {ORDERS_SQL} SELECT src.* FROM src LEFT JOIN tgt USING (id) WHERE tgt.id IS NULL", name="insert_new")
def new_orders(t: Tables) -> DataFrame:
    target, source = _orders(t)
    return insert_new(target, source, ["id"])


NULLABLE = "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END"


@query(
    f"""WITH s AS (SELECT {NULLABLE} AS id, o_orderstatus AS status, o_orderdate AS d FROM orders)
    SELECT id, status, strftime(d, '%Y-%m-%d') AS day FROM s a WHERE d >= TIMESTAMP '{SOURCE_START}'
      AND NOT EXISTS (SELECT 1 FROM s b WHERE b.d < TIMESTAMP '{TARGET_END}' AND b.id = a.id)"""
)
def insert_new_null_keys(t: Tables) -> DataFrame:
    """A fifth of the rows has no key: they match nothing and are always new."""
    rows = t.orders.select(
        F.expr(NULLABLE).alias("id"), F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("day")
    )
    new = insert_new(rows.where(F.col("day") < TARGET_END), rows.where(F.col("day") >= SOURCE_START), ["id"])
    return new.withColumn("day", F.col("day").cast("string"))


@query(
    f"""WITH {ORDERS_SQL} SELECT * FROM src UNION ALL
    SELECT tgt.* FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.id = tgt.id)"""
)
def upsert_full(t: Tables) -> DataFrame:
    target, source = _orders(t)
    return upsert(target, source, ["id"])


@query(
    f"""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice, 2) AS price, l_shipdate,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_extendedprice DESC) AS r
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SOURCE_START}'),
    src AS (SELECT l_orderkey, l_linenumber, l_partkey, price FROM l WHERE r = 1),
    tgt AS (SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, round(max(l_extendedprice), 2) AS price
      FROM lineitem WHERE l_shipdate < TIMESTAMP '{TARGET_END}' GROUP BY ALL)
    SELECT * FROM src UNION ALL SELECT tgt.* FROM tgt
    WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.l_orderkey = tgt.l_orderkey AND src.l_linenumber = tgt.l_linenumber)"""
)
def upsert_composite(t: Tables) -> DataFrame:
    """Two-column key; several batches appended to one, the newest of repeated keys taken."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = t.lineitem.select(*keys, "l_partkey", F.col("l_extendedprice").alias("price"), "l_shipdate")
    since = F.col("l_shipdate") >= F.lit(SOURCE_START).cast("timestamp_ntz")
    later = F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    before = F.col("l_shipdate") < F.lit(TARGET_END).cast("timestamp_ntz")
    batches = union_all([lines.where(since & ~later), lines.where(later)])
    target = lines.where(before).groupBy(*keys).agg(
        F.max("l_partkey").alias("l_partkey"), F.round(F.max("price"), 2).alias("price")
    )
    newest = latest_per_key(batches, keys, ["l_shipdate", "l_partkey", "price"])
    source = newest.select(*keys, "l_partkey", F.round("price", 2).alias("price"))
    return upsert(target, source, keys)


@query(
    f"""WITH d AS (SELECT strftime(l_shipdate, '%Y%m%d') AS id_date, l_suppkey AS campaign_id, l_shipdate,
        l_quantity, l_extendedprice FROM lineitem),
    tgt AS (SELECT id_date, campaign_id, 'old ' || campaign_id AS name, sum(l_quantity) AS clicks,
        round(sum(l_extendedprice), 2) AS cost FROM d WHERE l_shipdate < TIMESTAMP '{TARGET_END}' GROUP BY ALL),
    src AS (SELECT id_date, campaign_id, 'new ' || campaign_id AS name, sum(l_quantity) + 1 AS clicks,
        round(sum(l_extendedprice) * 2, 2) AS cost FROM d WHERE l_shipdate >= TIMESTAMP '{SOURCE_START}' GROUP BY ALL)
    SELECT id_date, campaign_id, coalesce(tgt.name, src.name) AS name, coalesce(src.clicks, tgt.clicks) AS clicks,
      coalesce(src.cost, tgt.cost) AS cost FROM tgt FULL JOIN src USING (id_date, campaign_id)""",
    name="upsert_partial",
)
def upsert_keeping_names(t: Tables) -> DataFrame:
    """Matched days keep the campaign name they were stored with."""
    lines = t.lineitem.select(
        F.date_format("l_shipdate", "yyyyMMdd").alias("id_date"),
        F.col("l_suppkey").alias("campaign_id"),
        "l_shipdate",
        "l_quantity",
        "l_extendedprice",
    )

    def daily(rows: DataFrame, label: str, clicks, cost) -> DataFrame:
        sums = rows.groupBy("id_date", "campaign_id").agg(clicks.alias("clicks"), F.round(cost, 2).alias("cost"))
        name = F.concat(F.lit(label), F.col("campaign_id").cast("string"))
        return sums.select("id_date", "campaign_id", name.alias("name"), "clicks", "cost")

    clicks, cost = F.sum("l_quantity"), F.sum("l_extendedprice")
    target = daily(lines.where(F.col("l_shipdate") < F.lit(TARGET_END).cast("timestamp_ntz")), "old ", clicks, cost)
    recent = lines.where(F.col("l_shipdate") >= F.lit(SOURCE_START).cast("timestamp_ntz"))
    source = daily(recent, "new ", clicks + 1, cost * 2)
    return upsert_partial(target, source, ["id_date", "campaign_id"], ["clicks", "cost"])


SEGMENT = "CASE WHEN c_acctbal < 2000 THEN 'AUTOMOBILE' ELSE c_mktsegment END"


@query(f"SELECT c_custkey, c_name, {SEGMENT} AS c_mktsegment FROM customer")
def scd1_update(t: Tables) -> DataFrame:
    """The segment of customers is overwritten where the incoming one differs."""
    target = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    source = t.customer.select("c_custkey", F.expr(SEGMENT).alias("c_mktsegment"))
    return update_changed(target, source, "c_custkey", "c_mktsegment")


@query(f"WITH {ORDERS_SQL} SELECT * FROM tgt WHERE id_date < '19980701' UNION ALL SELECT * FROM src", name="replace_range")
def replaced_days(t: Tables) -> DataFrame:
    target, source = _orders(t)
    return replace_range(target, source, "id_date", "19980701")


STORED = TableSpec(
    "stored_orders",
    T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("id_date", T.StringType()),
            T.StructField("status", T.StringType()),
            T.StructField("price", T.DoubleType()),
        ]
    ),
    keys=("id",),
    partition="id_date",
    cluster=("id",),
)


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn("id_date", F.concat(F.left("id_date", F.lit(6)), F.lit("01")))


MONTHS_SQL = f"""{ORDERS_SQL}, old AS (SELECT id, left(id_date, 6) || '01' AS id_date, status, price FROM tgt),
  new AS (SELECT id, left(id_date, 6) || '01' AS id_date, status, price FROM src)"""


@query(f"WITH {MONTHS_SQL} FROM old WHERE id_date < '19980701' UNION ALL FROM new")
def repeated_replace(t: Tables) -> DataFrame:
    """A stored table created, filled and then cut over three times by the same run."""
    target, source = _orders(t)
    root = scratch_path(t.spark, "stored")
    tables.create_table(t.spark, root, STORED)
    tables.rebuild(t.spark, root, STORED, _by_month(target))
    for _ in range(3):
        tables.replace_range(t.spark, root, STORED, _by_month(source), "19980701")
    return tables.read_table(t.spark, root, STORED)


@query(f"WITH {MONTHS_SQL} FROM new UNION ALL (FROM old WHERE id NOT IN (SELECT id FROM new))")
def stored_upsert(t: Tables) -> DataFrame:
    """A stored table rebuilt once and upserted twice, each time through a staged copy."""
    target, source = _orders(t)
    root = scratch_path(t.spark, "stored")
    tables.rebuild(t.spark, root, STORED, _by_month(target))
    for _ in range(2):
        tables.upsert(t.spark, root, STORED, _by_month(source))
    return tables.read_table(t.spark, root, STORED)


@query(f"WITH {MONTHS_SQL} FROM new UNION ALL (FROM old WHERE id NOT IN (SELECT id FROM new))")
def interrupted_upsert(t: Tables) -> DataFrame:
    """An upsert whose run died after its commit record, some partitions moved: the next reader completes it."""
    target, source = _orders(t)
    root = scratch_path(t.spark, "stored")
    path = tables.table_path(root, STORED)
    tables.rebuild(t.spark, root, STORED, _by_month(target))
    lost = exchange.new_folder(path)
    tables._write(_by_month(source), lost, STORED, "overwrite")  # a run that died before its record: no effect
    new = exchange.new_folder(path)
    merged = upsert(tables.read_table(t.spark, root, STORED), _by_month(source), STORED.keys)
    tables._write(merged, new, STORED, "overwrite")
    months = [n for n in exchange.names(t.spark, new) if n.startswith("id_date=")]
    exchange.commit(t.spark, path, new, months, [])
    for n, month in enumerate(months):  # a third not begun, a third without a folder, the rest done
        if n % 3:
            exchange.remove(t.spark, f"{path}/{month}")
        if n % 3 > 1:
            exchange.rename(t.spark, f"{new}/{month}", f"{path}/{month}")
    return tables.read_table(t.spark, root, STORED)


def _changed_later(t: Tables) -> str:
    """A table with two batches of change files: the older one has other prices, and is replaced."""
    target, source = _orders(t)
    root = scratch_path(t.spark, "stored")
    tables.rebuild(t.spark, root, STORED, _by_month(target))
    tables.upsert_later(t.spark, root, STORED, _by_month(source).withColumn("price", F.col("price") + 1))
    tables.upsert_later(t.spark, root, STORED, _by_month(source))
    return root


@query(f"WITH {MONTHS_SQL} FROM new UNION ALL (FROM old WHERE id NOT IN (SELECT id FROM new))")
def deferred_upsert(t: Tables) -> DataFrame:
    """A stored table read with its change files, the newest change of a key in place of the stored row."""
    return tables.read_table(t.spark, _changed_later(t), STORED)


@query(f"WITH {MONTHS_SQL} FROM new UNION ALL (FROM old WHERE id NOT IN (SELECT id FROM new))")
def compacted_upsert(t: Tables) -> DataFrame:
    """The same table after its change files have been folded in, some buckets first."""
    root = _changed_later(t)
    tables.compact(t.spark, root, STORED, range(3))
    tables.compact(t.spark, root, STORED)
    return tables.read_table(t.spark, root, STORED)


@query(
    f"""WITH {MONTHS_SQL}, moved AS (SELECT id, '19990201' AS id_date, status, -price AS price FROM old WHERE id % 97 = 0)
    FROM moved UNION ALL (FROM old WHERE id NOT IN (SELECT id FROM moved))"""
)
def filtered_upsert(t: Tables) -> DataFrame:
    """Few keys, stored in other partitions than the rows fall into: key filters tell which to open."""
    target, _ = _orders(t)
    root = scratch_path(t.spark, "stored")
    old = _by_month(target)
    tables.rebuild(t.spark, root, STORED, old)
    moved = old.where("id % 97 = 0").withColumns({"id_date": F.lit("19990201"), "price": -F.col("price")})
    for _ in range(2):  # the second run finds the filters the first has left
        tables.upsert(t.spark, root, STORED, moved)
    return tables.read_table(t.spark, root, STORED)


@query(
    f"""WITH s AS (SELECT {NULLABLE} AS id, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
    SELECT DISTINCT id, status, day, CASE WHEN id IS NULL THEN 'no key' ELSE 'key' END AS kind FROM s WHERE day >= '1999-01-01'
      OR (id IS NULL AND status = 'F')"""
)
def keyless_rows(t: Tables) -> DataFrame:
    """Rows without a key are new only if no equal row is stored."""
    rows = t.orders.select(
        F.expr(NULLABLE).alias("id"), F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").cast("string").alias("day")
    ).distinct()
    stored = rows.where((F.col("day") < "1999-01-01") & ~(F.col("id").isNull() & (F.col("status") == "F")))
    new = insert_new(stored, rows, ["id"], compare_keyless=True)
    return new.withColumn("kind", F.when(F.col("id").isNull(), "no key").otherwise("key"))


CONFORMED = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("created_at", T.DateType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("etl_load_date", T.TimestampType()),
    ]
)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d') AS created_at,
    o_totalprice AS price, '2024-02-01 06:00:00' AS etl_load_date FROM orders"""
)
def conform_schema(t: Tables) -> DataFrame:
    """Columns in another order, other types and with extras brought into the declared schema."""
    shuffled = t.orders.select(
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("extra"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("created_at"),
    )
    rows = conform(shuffled, CONFORMED, load_time=datetime(2024, 2, 1, 6))
    return rows.withColumns({c: F.col(c).cast("string") for c in ("created_at", "etl_load_date")})
