"""The session table over the driver's star-schema tables.

One row per order (``FIXTURES.md`` §2). The narrow order rows meet
customer/nation, the per-order line aggregate and part; the wide review text
is attached last (``attach_text``), so it crosses the network once and only
for queries that read it. Every join is a left join on a primary key, so
row count = orders.

The small lookup sides are written as one row per key (an aggregate on the
key). That states the primary key to Catalyst, which then removes a lookup
join from any plan that reads none of its columns (e.g. the raw-mean
subquery reads only ``orders``). For unique keys the aggregate returns the
rows unchanged.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.functions.joins import split_join

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


SESSION_TABLES = ["orders", "lineitem", "part", "customer", "nation", "documents"]  # the view reads these

_RELATIONS: dict[tuple[str, str], tuple[tuple, DataFrame]] = {}


def file_state(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """Name, length and time of each file of a table, from the file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(sf_dir, f"{name}.parquet"))
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a lazy relation. A relation is kept for as long as the
    table's files stay as they are, so building many queries does not read
    footers again for each one, and new files are never missed."""
    key = (spark.sparkContext.applicationId, os.path.join(sf_dir, f"{name}.parquet"))
    state = file_state(spark, sf_dir, name)
    kept = _RELATIONS.get(key)
    if kept is None or kept[0] != state or kept[1].sparkSession is not spark:
        kept = _RELATIONS[key] = (state, spark.read.parquet(key[1]))
    return kept[1]


def session_view(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """Raw sessions (input schema + ``session_id``) derived from the tables.

    ``with_text=False`` skips the documents join (``review_text`` is null);
    valid because ``doc_id`` is a key, so the join never changes row count.
    """
    orders = read_table(spark, sf_dir, "orders")
    lines = (read_table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.sum("l_linenumber").cast("int").alias("sd"),
                  F.count(F.lit(1)).cast("int").alias("pv"),
                  F.min("l_partkey").alias("pk")))
    part = (read_table(spark, sf_dir, "part")
            .groupBy("p_partkey").agg(F.max("p_type").alias("p_type")))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    buyers = (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
              .groupBy("c_custkey").agg(F.max("n_name").alias("n_name")))
    # a hot customer or part is split by AQE; orders without lines have no part
    # key and are spread over the part join
    s = split_join(orders, buyers, "o_custkey", "c_custkey", spread_nulls=["o_orderkey"])
    s = s.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    s = split_join(s, part, "pk", "p_partkey", spread_nulls=["o_orderkey"])
    key = F.col("o_orderkey")
    cols = [
        key.alias("session_id"),
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(key % 97 == 0, F.lit(-1)).otherwise(F.col("sd")).alias("session_duration"),
        F.when(key % 89 == 0, F.lit(-1)).otherwise(F.col("pv")).alias("pages_viewed"),
        F.col("p_type").alias("product_category"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("purchase_amount"),
        F.when(key % 11 == 0, F.lit(None).cast("double"))
         .otherwise(F.substring("o_orderpriority", 1, 1).cast("double")).alias("review_score"),
        F.timestamp_add("SECOND", key * 7919 % 86400, F.col("o_orderdate")).alias("timestamp"),
        F.when(key % 5 < 3, F.lit("Mobile")).otherwise(F.lit("Desktop")).alias("device_type"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("CITY_"), (F.col("o_custkey") % 100).cast("string")).alias("city"),
    ]
    cols.insert(7, F.lit(None).cast("string").alias("review_text"))
    view = s.select(*cols)
    return attach_text(spark, sf_dir, view) if with_text else view


def attach_text(spark: SparkSession, sf_dir: str, sessions: DataFrame) -> DataFrame:
    """Fill ``review_text`` from the documents table (left join on the key).

    Can be applied after cleaning, which never reads the text: the filter
    then shrinks the join input and the raw-mean pass never touches text.
    Text grows with the data, so it is never broadcast; the sort-merge join
    also spreads the texts over the shuffle partitions, so per-row text work
    after the join runs in parallel.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").hint("merge")
    cols = [F.col("text").alias("review_text") if c == "review_text" else F.col(c)
            for c in sessions.columns]
    return (sessions.join(docs, sessions.session_id == docs.doc_id, "left")
            .select(*cols))
