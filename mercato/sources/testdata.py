"""Bronze tables derived from the TPC-H-like test tables.

The test tables carry no payments, reviews, delivery dates, leads or state
document, so each bronze table is a view over them whose columns are pure
functions of the keys.  The views are written once, as SQL expressions that
Spark (``selectExpr``) and DuckDB (the correctness oracle) both accept, so
the two engines see the same raw data.

Every view reads whole tables and keeps their rows: where a row is to have no
partner (an item without order, a review without order, a deal without lead,
a category without translation), its key is shifted out of range.  Second
reviews and payments are rows added for some orders; leads and deals are the
events of their type.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources.lazy import LazyTables

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


@dataclass(frozen=True)
class Part:
    tables: tuple[str, ...]          # first table, then joined ones
    join_on: tuple[str, ...]         # one inner-join condition per joined table
    select: tuple[str, ...]
    where: str | None = None
    distinct: bool = False


ORDER_TS = "CAST(o_orderkey * 7919 % 86400 AS INT)"

VIEWS: dict[str, tuple[Part, ...]] = {
    "customers": (Part(
        ("customer", "nation"), ("c_nationkey = n_nationkey",),
        ("c_custkey AS customer_id",
         "CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END AS customer_unique_id",
         "'  ' || lower(n_name) || ' ' AS customer_city",
         "' ' || chr(97 + n_nationkey) || chr(97 + n_regionkey) AS customer_state")),),
    "sellers": (Part(
        ("supplier", "nation"), ("s_nationkey = n_nationkey",),
        ("s_suppkey AS seller_id",
         "' ' || lower(n_name) AS seller_city",
         "chr(97 + n_nationkey) || chr(97 + n_regionkey) || ' ' AS seller_state")),),
    "orders": (Part(
        ("orders",), (),
        ("o_orderkey AS order_id",
         "o_custkey AS customer_id",
         "CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped' "
         "WHEN o_orderpriority = '5-LOW' THEN 'canceled' "
         "WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unavailable' ELSE 'processing' END AS order_status",
         f"CAST(o_orderdate + INTERVAL '1' SECOND * {ORDER_TS} AS STRING) AS order_purchase_timestamp",
         "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL '1' SECOND * "
         "CAST(o_orderkey * 7919 % 86400 + o_orderkey * 104729 % 2592000 AS INT) AS STRING) "
         "WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN 'not a date' END "
         "AS order_delivered_customer_date",
         "' ' || CAST(o_orderdate + INTERVAL '1' DAY * CAST(10 + o_orderkey % 20 AS INT) AS STRING) || ' ' "
         "AS order_estimated_delivery_date")),),
    "order_items": (Part(
        ("lineitem",), (),
        ("CASE WHEN l_orderkey % 97 = 0 THEN l_orderkey + 10000000000 ELSE l_orderkey END AS order_id",
         "l_linenumber AS order_item_id",
         "l_partkey AS product_id",
         "l_suppkey AS seller_id",
         "CASE WHEN l_discount = 0 AND l_tax = 0 THEN 0.0 ELSE l_extendedprice END AS price",
         "l_quantity AS freight_value")),),
    "products": (Part(
        ("part",), (),
        ("p_partkey AS product_id",
         "CASE WHEN p_brand = 'Brand#6' THEN NULL ELSE lower(p_type) END AS product_category_name",
         "p_size * 1050 - 1050 AS product_weight_g",
         "p_size AS product_length_cm",
         "p_size AS product_height_cm",
         "p_size AS product_width_cm")),),
    "product_category_name_translation": (Part(
        ("part",), (),
        ("CASE WHEN p_type = 'PROMO' THEN 'no such category' ELSE lower(p_type) END AS product_category_name",
         "'en_' || lower(p_type) AS product_category_name_english"),
        distinct=True),),
    "order_payments": (
        Part(("orders",), (),
             ("o_orderkey AS order_id",
              "1 AS payment_sequential",
              "CASE WHEN o_orderpriority = '1-URGENT' THEN 'CREDIT_CARD' "
              "WHEN o_orderpriority = '2-HIGH' THEN 'Boleto' ELSE 'VOUCHER' END AS payment_type",
              "1 + o_orderkey % 12 AS payment_installments",
              "CASE WHEN o_orderkey % 50 = 0 THEN 0.0 ELSE o_totalprice END AS payment_value")),
        Part(("orders",), (),
             ("o_orderkey AS order_id", "2 AS payment_sequential", "'debit_card' AS payment_type",
              "CAST(1 AS BIGINT) AS payment_installments", "CAST(25.5 AS DOUBLE) AS payment_value"),
             where="o_orderkey % 5 = 0"),
    ),
    "order_reviews": (
        Part(("orders",), (),
             ("o_orderkey AS review_id",
              "CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 20000000000 ELSE o_orderkey END AS order_id",
              "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 1 + o_orderkey % 5 END AS review_score",
              "CAST(o_orderdate AS STRING) AS review_creation_date",
              "CAST(o_orderdate AS STRING) AS review_answer_timestamp")),
        Part(("orders",), (),
             ("o_orderkey + 1000000000 AS review_id", "o_orderkey AS order_id",
              "CAST(1 AS BIGINT) AS review_score", "'not a date' AS review_creation_date",
              "'' AS review_answer_timestamp"),
             where="o_orderkey % 9 = 1"),
    ),
    "marketing_leads": (Part(
        ("events",), (),
        ("user_id AS mql_id",
         "CAST(CAST(ts AS DATE) AS STRING) AS first_contact_date",
         "CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'channel_' || CAST(user_id % 7 AS STRING) END AS origin",
         "event_id"),
        where="event_type = 'signup'"),),
    "closed_deals": (Part(
        ("events",), (),
        ("CASE WHEN user_id % 3 = 0 THEN user_id ELSE user_id + 10000000000 END AS mql_id",
         "CASE WHEN user_id % 30 = 3 THEN 'not a date' "
         "ELSE CAST(CAST(ts AS DATE) AS STRING) || ' 12:00:00' END AS won_date",
         "event_id"),
        where="event_type = 'purchase'"),),
    # Flat form of the state document; ``geo_document`` nests it.
    "geo_states": (Part(
        ("nation",), (),
        ("CASE WHEN n_nationkey < 24 THEN chr(65 + n_nationkey) || chr(65 + n_regionkey) ELSE 'no state' END AS state_id",
         "n_name AS state_name",
         "n_regionkey AS doc_id")),),
}

# Which row survives keep-one-per-key in the derived tables: the lowest
# customer id, and for leads and deals the lowest event id.
DEDUPE_ORDER = {
    "customers": ("customer_id",),
    "marketing_leads": ("event_id",),
    "closed_deals": ("event_id",),
}

# --- Spark side ---------------------------------------------------------------

# The test tables are read-only, so a session resolves each file once (file
# listing and footer read happen on the driver when a DataFrame is built).
# The cache hangs on the session and goes with it.


def path(sf_dir: str, table: str) -> str:
    return f"{sf_dir}/{table}.parquet"


class _Reader:
    """Reads test tables, each resolved at most once per session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._seen = spark.__dict__.setdefault("_mercato_test_tables", {})

    def __call__(self, table: str) -> DataFrame:
        at = path(self.sf_dir, table)
        if at not in self._seen:
            self._seen[at] = self.spark.read.parquet(at)
        return self._seen[at]


def _part_df(read: _Reader, part: Part) -> DataFrame:
    df = read(part.tables[0])
    for table, cond in zip(part.tables[1:], part.join_on):
        df = df.join(read(table), F.expr(cond), "inner")
    if part.where:
        df = df.where(part.where)
    df = df.selectExpr(*part.select)
    return df.distinct() if part.distinct else df


def _view(read: _Reader, name: str) -> DataFrame:
    parts = [_part_df(read, p) for p in VIEWS[name]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as it is."""
    return _Reader(spark, sf_dir)(name)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _view(_Reader(spark, sf_dir), name)


def _geo_document(read: _Reader) -> DataFrame:
    flat = _view(read, "geo_states")
    feature = F.struct(F.col("state_id").alias("id"),
                       F.struct(F.col("state_name").alias("name")).alias("properties"))
    return flat.groupBy("doc_id").agg(F.collect_list(feature).alias("features")).select("features")


def geo_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states as GeoJSON-like documents, one per region:
    ``features: array<struct<id, properties: struct<name>>>``.  A region
    holds five nations, so each document is small and bounded."""
    return _geo_document(_Reader(spark, sf_dir))


def bronze_tables(spark: SparkSession, sf_dir: str = DEFAULT_SF_DIR) -> LazyTables:
    """All bronze tables derived from ``sf_dir``, each built on first use."""
    read = _Reader(spark, sf_dir)
    builders = {name: (lambda n=name: _view(read, n)) for name in VIEWS if name != "geo_states"}
    builders["geo"] = lambda: _geo_document(read)
    return LazyTables(builders)


# --- SQL side -----------------------------------------------------------------

def view_sql(name: str) -> str:
    sqls = []
    for p in VIEWS[name]:
        src = p.tables[0]
        for table, cond in zip(p.tables[1:], p.join_on):
            src += f" JOIN {table} ON {cond}"
        sql = f"SELECT {'DISTINCT ' if p.distinct else ''}{', '.join(p.select)} FROM {src}"
        if p.where:
            sql += f" WHERE {p.where}"
        sqls.append(sql)
    return " UNION ALL ".join(sqls)


def raw_ctes() -> dict[str, str]:
    """``raw_<name>`` CTE bodies for the oracle."""
    return {f"raw_{name}": view_sql(name) for name in VIEWS}
