"""Contract tables derived from the given test tables (TPC-H-like star schema + events).

Each adapter is a plain projection/join of the parquet tables, so the work grows with the tables.
Dirty data (bad e-mails, null keys, exact duplicates, orphans, future dates, out-of-range values) is
injected deterministically from the keys; no row is dropped. The same views exist as SQL in
``lakehold.plans.oracle`` for the DuckDB cross-check.

``columns`` names the columns that are needed (None: all); joins that serve none of them are left
out. ``lines`` is the written table of ``lines_with_orders``. ``later`` adds what they would have given to rows that were read without, by the link ``_order``. ``_ordinal`` is a row's position in the scan, taken before any join.
"""
from __future__ import annotations

import os
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehold import contracts as C

# Values of the test tables, over the product contracts
GENRES = ("STANDARD", "SMALL", "LARGE", "ECONOMY", "MEDIUM")
EVENT_TYPES = ("view", "click", "purchase", "signup")


def _with_set(c: C.Contract, column: str, values: tuple) -> C.Contract:
    return replace(c, rules=tuple(replace(r, param=values) if (r.kind, r.column) == ("in_set", column) else r for r in c.rules))


CONTRACTS: dict[str, C.Contract] = {
    **C.CONTRACTS,
    "books": _with_set(C.CONTRACTS["books"], "genre", GENRES),
    "access_events": _with_set(C.CONTRACTS["access_events"], "event_type", EVENT_TYPES),
    # the SQL twins cannot see scan positions: these columns order the rows of a key
    "loans": replace(C.CONTRACTS["loans"], order_by=("loan_date", "l_suppkey", "l_extendedprice", "book_id", "l_quantity")),
    "ratings": replace(C.CONTRACTS["ratings"], order_by=("rating_date", "l_suppkey", "l_extendedprice")),
}

# Fixed adapter parameters (must equal the SQL views in lakehold.plans.oracle)
AS_OF = {"readers": "2026-01-01 00:00:00", "loans": "2001-01-01 00:00:00",
         "*": "2026-01-01 00:00:00"}
LATER_AS_OF = {"readers": "2026-01-01 00:00:00", "loans": "2002-01-01 00:00:00",
               "*": "2026-01-01 00:00:00"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _copied(df: DataFrame, twice: Column) -> DataFrame:
    """Rows of ``twice`` come two times; positions are doubled, so that copies have their own."""
    copies = F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return df.withColumn("_copy", copies).withColumn("_ordinal", F.col("_ordinal") * 2 + F.col("_copy")).drop("_copy")


def _placed(df: DataFrame, twice: Column) -> DataFrame:
    """Rows with their scan position; those of ``twice`` come two times."""
    return _copied(df.withColumn("_ordinal", F.monotonically_increasing_id()), twice)


def _asked(df: DataFrame, columns) -> DataFrame:
    return df if columns is None else df.select(*[c for c in df.columns if c in columns or c == "_ordinal"])


def _none_if(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def readers(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    k = F.col("c_custkey")
    cust = _placed(table(spark, sf_dir, "customer"), k % 251 == 9)
    email = (F.when(k % 97 == 5, F.concat(F.lit("c"), k.cast("string"), F.lit("_at_ex.com")))
             .when(k % 89 == 7, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                                 F.lit("@ex"), F.col("c_nationkey").cast("string"), F.lit(".com"))))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    signup = (F.when(k % 101 == 3, F.lit("not-a-date"))
              .when(k % 103 == 4, F.lit("2999-01-01"))
              .otherwise(F.concat((F.lit(2019) + k % 3).cast("string"), F.lit("-"),
                                  two(F.lit(1) + k % 12), F.lit("-"), two(F.lit(1) + k % 28))))
    city = []
    if columns is None or "city" in columns:
        nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
        cust, city = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left"), ["city"]
    return _asked(cust.select(_none_if(k % 257 == 10, k).alias("reader_id"), F.col("c_name").alias("name"), email.alias("email"),
                              *city, signup.alias("signup_date"), "_ordinal"), columns)


def books(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    k = F.col("p_partkey")
    year = F.when(k % 83 == 2, F.lit(3000)).otherwise(F.lit(1950) + k % 77).cast("long")
    return _asked(_placed(table(spark, sf_dir, "part"), k % 241 == 11).select(
        _none_if(k % 263 == 12, k).alias("book_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("author"),
        F.col("p_type").alias("genre"), year.alias("year"), "_ordinal"), columns)


def _line_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")


def lines_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What loans and ratings have in common, to be written where it is read often: lines at their scan
    positions, each with its order."""
    li = _line_columns(spark, sf_dir).withColumn("_ordinal", F.monotonically_increasing_id())
    return _with_orders(spark, sf_dir, li, "l_orderkey").drop("o_orderkey")


def _lines(spark: SparkSession, sf_dir: str, twice: Column, with_orders: bool, stored: DataFrame | None) -> DataFrame:
    if stored is not None:
        return _copied(stored, twice)
    li = _placed(_line_columns(spark, sf_dir), twice)
    if not with_orders:
        return li.withColumn("o_custkey", F.lit(None).cast("long"))
    return _with_orders(spark, sf_dir, li, "l_orderkey")


def _with_orders(spark: SparkSession, sf_dir: str, rows: DataFrame, link: str) -> DataFrame:
    # both grow with the data: sorted and merged at any size, never a broadcast that stops fitting
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").hint("merge")
    return rows.join(orders, rows[link] == orders.o_orderkey, "left")


def _reader(order: Column, rest: int) -> Column:
    return F.when(order % 100 == rest, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey"))


def _link(columns) -> list[Column]:
    return [F.col("l_orderkey").alias("_order")] if columns is not None and "_order" in columns else []


def loans(spark: SparkSession, sf_dir: str, columns=None, lines: DataFrame | None = None) -> DataFrame:
    ok = F.col("l_orderkey")
    reader = _reader(ok, 1)
    book = F.when(ok % 91 == 2, F.lit(None).cast("long")).when(ok % 113 == 7, F.col("l_partkey") + 10000000).otherwise(F.col("l_partkey"))
    return _asked(_lines(spark, sf_dir, ok % 211 == 3, columns is None or "reader_id" in columns, lines).select(
        _none_if(ok % 307 == 5, ok * 8 + F.col("l_linenumber")).alias("loan_id"), reader.alias("reader_id"),
        book.alias("book_id"), F.col("l_shipdate").alias("loan_date"),
        "l_suppkey", "l_extendedprice", "l_quantity", "_ordinal", *_link(columns)), columns)


def ratings(spark: SparkSession, sf_dir: str, columns=None, lines: DataFrame | None = None) -> DataFrame:
    ok = F.col("l_orderkey")
    reader = _reader(ok, 2)
    book = F.when(ok % 127 == 9, F.col("l_partkey") + 10000000).otherwise(F.col("l_partkey"))
    return _asked(_lines(spark, sf_dir, ok % 199 == 4, columns is None or "reader_id" in columns, lines).select(
        _none_if(ok % 311 == 6, ok * 8 + F.col("l_linenumber")).alias("rating_id"), reader.alias("reader_id"),
        book.alias("book_id"), (F.col("l_quantity").cast("long") % 7).alias("rating"),
        F.col("l_shipdate").alias("rating_date"), "l_suppkey", "l_extendedprice", "_ordinal", *_link(columns)), columns)


def decode_props(props) -> Column:
    """Event properties are JSON text ``{"k": n}``; ``k`` is the book id."""
    return F.from_json(props, "k BIGINT").getField("k")


def access_events(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return _asked(table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").alias("reader_id"),
        "event_type", decode_props(F.col("props")).alias("book_id"),
        F.col("ts").alias("event_ts"), "props"), columns)


ADAPTERS = {"readers": readers, "books": books, "loans": loans, "ratings": ratings,
            "access_events": access_events}


LINK = "_order"
READER_REST = {"loans": 1, "ratings": 2}
# columns that come from a join which grows with the data, by dataset
LATE = {name: {"reader_id"} for name in READER_REST}


def later(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame) -> DataFrame:
    """Rows read with ``_order`` and without the columns ``LATE`` -> with these, as the adapter gives them."""
    return _with_orders(spark, sf_dir, rows, LINK).withColumn("reader_id", _reader(F.col(LINK), READER_REST[name])).drop(
        LINK, "o_orderkey", "o_custkey")


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders that a row finds several times: o_orderkey, times."""
    orders = table(spark, sf_dir, "orders").where("o_orderkey is not null")
    return orders.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("times")).where("times > 1")


def load_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in ADAPTERS.items()}
