"""Gold aggregates over Silver tables.

Facts (loans, ratings) are aggregated per ``book_id`` *before* the join with books, so
a hot book never reaches the join and the shuffle carries one row per book and map task
(partial aggregation). Silver books are unique on ``book_id``, so counting before or
after the join gives the same numbers as the join-then-group formulation.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.contracts import DASHBOARD_TOP_N, MIN_RATINGS_PER_BOOK, SERVING_TOP_N, TOP_N
from lakehold.functions.dates import month_text
from lakehold.operators.quality import round_half_up

KPI_METRICS = (("total_readers", "readers"), ("total_books", "books"),
               ("total_loans", "loans"), ("total_ratings", "ratings"),
               ("total_access_events", "access_events"))


def _loans_per_book(loans: DataFrame) -> DataFrame:
    return (loans.where(F.col("book_id").isNotNull())
            .groupBy("book_id").agg(F.count("loan_id").alias("total_loans")))


def top_books(loans: DataFrame, books: DataFrame, n: int = TOP_N) -> DataFrame:
    """Most borrowed books: book_id, title, genre, total_loans; ties broken by book_id."""
    per_book = _loans_per_book(loans)
    return (per_book.join(books.select("book_id", "title", "genre"), "book_id")
            .select("book_id", "title", "genre", "total_loans")
            .orderBy(F.desc("total_loans"), F.asc("book_id")).limit(n))


def usage_by_genre(loans: DataFrame, books: DataFrame) -> DataFrame:
    """Loans per genre (a null genre is a group of its own)."""
    per_book = _loans_per_book(loans)
    return (per_book.join(books.select("book_id", "genre"), "book_id")
            .groupBy("genre").agg(F.sum("total_loans").cast("long").alias("total_loans"))
            .orderBy(F.desc("total_loans"), F.asc_nulls_last("genre")))


def rating_by_book(ratings: DataFrame, books: DataFrame, min_ratings: int = MIN_RATINGS_PER_BOOK,
                   n: int = TOP_N) -> DataFrame:
    """Best rated books with at least ``min_ratings`` ratings; average rounded half-up to 2."""
    per_book = (ratings.where(F.col("book_id").isNotNull())
                .groupBy("book_id")
                .agg(F.sum("rating").alias("_sum"), F.count("rating").alias("_n_avg"),
                     F.count("rating_id").alias("n_ratings"))
                .where(F.col("n_ratings") >= min_ratings))
    avg = F.try_divide(F.col("_sum").cast("double"), F.col("_n_avg"))
    return (per_book.join(books.select("book_id", "title", "genre"), "book_id")
            .select("book_id", "title", "genre", round_half_up(avg, 2).alias("avg_rating"),
                    "n_ratings")
            .orderBy(F.desc("avg_rating"), F.desc("n_ratings"), F.asc("book_id")).limit(n))


def rating_distribution(ratings: DataFrame) -> DataFrame:
    """Ratings per value, values 1..5 (inclusive, null excluded)."""
    return (ratings.where(F.col("rating").between(1, 5))
            .groupBy("rating").agg(F.count(F.lit(1)).alias("total")).orderBy("rating"))


def loans_by_month(loans: DataFrame) -> DataFrame:
    """Loans per ``yyyy-MM`` of the loan date (null dates excluded)."""
    return (loans.where(F.col("loan_date").isNotNull())
            .groupBy(month_text(F.col("loan_date")).alias("month"))
            .agg(F.count(F.lit(1)).alias("total_loans")).orderBy("month"))


def events_by_type(events: DataFrame) -> DataFrame:
    return (events.groupBy("event_type").agg(F.count(F.lit(1)).alias("total"))
            .orderBy(F.desc("total"), F.asc_nulls_last("event_type")))


def kpis(tables: dict[str, DataFrame]) -> DataFrame:
    """Five headline counts in long form (metric, value); a missing table counts 0.
    One global aggregate per table (partial counts per task, no shuffle of rows)."""
    parts = []
    for metric, name in KPI_METRICS:
        df = tables.get(name)
        if df is None:
            parts.append(None)
            continue
        parts.append(df.agg(F.count(F.lit(1)).alias("value"))
                     .select(F.lit(metric).alias("metric"), F.col("value").cast("long")))
    spark = next(p for p in parts if p is not None).sparkSession
    out = None
    for (metric, _), p in zip(KPI_METRICS, parts):
        if p is None:
            p = spark.range(1).select(F.lit(metric).alias("metric"), F.lit(0).cast("long").alias("value"))
        out = p if out is None else out.unionByName(p)
    return out


GOLD_QUERIES = ("top_books", "usage_by_genre", "rating_by_book", "rating_distribution",
                "loans_by_month", "events_by_type")


def gold_tables(silver: dict[str, DataFrame], only: tuple | None = None) -> dict[str, DataFrame]:
    """The six Gold tables plus ``kpis``. A query is skipped only when one of its input
    tables is missing; any other error propagates."""
    need = {"top_books": ("loans", "books"), "usage_by_genre": ("loans", "books"),
            "rating_by_book": ("ratings", "books"), "rating_distribution": ("ratings",),
            "loans_by_month": ("loans",), "events_by_type": ("access_events",)}
    build = {
        "top_books": lambda s: top_books(s["loans"], s["books"]),
        "usage_by_genre": lambda s: usage_by_genre(s["loans"], s["books"]),
        "rating_by_book": lambda s: rating_by_book(s["ratings"], s["books"]),
        "rating_distribution": lambda s: rating_distribution(s["ratings"]),
        "loans_by_month": lambda s: loans_by_month(s["loans"]),
        "events_by_type": lambda s: events_by_type(s["access_events"]),
    }
    out = {}
    for name in GOLD_QUERIES:
        if only is not None and name not in only:
            continue
        if all(t in silver for t in need[name]):
            out[name] = build[name](silver)
    if silver and (only is None or "kpis" in only):
        out["kpis"] = kpis(silver)
    return out


GOLD_INPUTS = {"top_books": ("loans", "books"), "usage_by_genre": ("loans", "books"),
               "rating_by_book": ("ratings", "books"), "rating_distribution": ("ratings",),
               "loans_by_month": ("loans",), "events_by_type": ("access_events",),
               "kpis": ("readers", "books", "loans", "ratings", "access_events")}


# ---- serving queries over Gold tables ------------------------------------------------

def serving_top_books(top: DataFrame, n: int = SERVING_TOP_N) -> DataFrame:
    return (top.orderBy(F.desc("total_loans"), F.asc("book_id")).limit(n)
            .select("title", "genre", "total_loans"))


def serving_top_books_chart(top: DataFrame, n: int = DASHBOARD_TOP_N) -> DataFrame:
    return (top.orderBy(F.desc("total_loans"), F.asc("book_id")).limit(n)
            .select("title", "genre", "total_loans"))


def serving_genre_usage(usage: DataFrame) -> DataFrame:
    return usage.select("genre", "total_loans").orderBy(F.desc("total_loans"))


def serving_best_rated(rated: DataFrame, n: int = SERVING_TOP_N) -> DataFrame:
    return (rated.orderBy(F.desc("avg_rating"), F.desc("n_ratings"), F.asc("book_id")).limit(n)
            .select("title", "avg_rating", "n_ratings"))


def serving_events_by_type(ev: DataFrame) -> DataFrame:
    return ev.select("event_type", "total").orderBy(F.desc("total"))
