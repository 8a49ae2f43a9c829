"""Registered queries (Spark) and their DuckDB oracle SQL, one key per operator.

Every query reads the given tables through the adapters, so its work grows with them.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehold.contracts import ALL_DATASETS, BATCH_DATASETS, SILVER_REASON
from lakehold.functions.privacy import TEST_SALT, mask_email, pseudonym
from lakehold.operators import gold as G
from lakehold.operators import quality as Q
from lakehold.operators.keys import dedup_keep_first
from lakehold.operators.quarantine import quarantine_view
from lakehold.operators.silver import drop_control, normalise_dates
from lakehold.plans import oracle as O
from lakehold.plans.derived import Chain
from lakehold.sources import testdata as td
from lakehold.sources.lake import with_control_columns
from lakehold.sources.testdata import CONTRACTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# fixed run identity for the Bronze-shaped queries
RUN_ID = "run-0001"
RUN_TS = "2026-01-01T00:00:00"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _union(frames):
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


# ---- rules -----------------------------------------------------------------------------

def _violations(spark, sf_dir, kind: str) -> DataFrame:
    ch = Chain(spark, sf_dir)
    frames = []
    for ds in ALL_DATASETS:
        c = CONTRACTS[ds]
        if not any(r.kind == kind for r in c.rules):
            continue
        fl = ch.violations(ds, kind)
        for i, r in enumerate(c.rules):
            if r.kind == kind:
                frames.append(fl.df.where(F.col(fl.flag_cols[i])).select(
                    F.lit(ds).alias("dataset"), F.lit(r.kind).alias("rule"), F.lit(r.column).alias("column"),
                    F.col(c.row_key).cast("string").alias("row_key")))
    return _union(frames)


def _violations_sql(kind: str) -> str:
    parts = []
    for ds, cte, key, rules in O.RULES:
        for i, (k, col, _) in enumerate(rules):
            if k == kind:
                parts.append(f"SELECT '{ds}' AS dataset, '{k}' AS rule, '{col}' AS \"column\", "
                             f"CAST({key} AS VARCHAR) AS row_key FROM {cte} WHERE r{i}")
    return O.with_chain("\nUNION ALL\n".join(parts))


for _kind in ("not_null", "unique", "in_set", "in_range", "regex", "not_future", "fk"):
    def _mk(kind):
        return lambda spark, sf_dir: _violations(spark, sf_dir, kind)
    query(f"rule_{_kind}", _violations_sql(_kind))(_mk(_kind))


def _missing_column_sql() -> str:
    return O.with_chain("""
SELECT 'books' AS dataset, CAST(0 AS BIGINT) AS rule_index, 'not_null' AS rule, 'book_id' AS "column",
  count(*) FILTER (WHERE NOT r0) AS passed, count(*) FILTER (WHERE r0) AS failed, '' AS detail FROM f_books
UNION ALL SELECT 'books', CAST(1 AS BIGINT), 'unique', 'book_id', count(*) FILTER (WHERE NOT r1),
  count(*) FILTER (WHERE r1), '' FROM f_books
UNION ALL SELECT 'books', CAST(2 AS BIGINT), 'not_null', 'title', CAST(0 AS BIGINT), count(*), 'column missing' FROM f_books
UNION ALL SELECT 'books', CAST(3 AS BIGINT), 'in_range', 'year', count(*) FILTER (WHERE NOT r3),
  count(*) FILTER (WHERE r3), '1450..2026' FROM f_books
UNION ALL SELECT 'books', CAST(4 AS BIGINT), 'in_set', 'genre', count(*) FILTER (WHERE NOT r4),
  count(*) FILTER (WHERE r4), 'STANDARD,SMALL,LARGE,ECONOMY,MEDIUM' FROM f_books""")


@query("rule_missing_column", _missing_column_sql())
def rule_missing_column(spark, sf_dir):
    """The books source without its ``title`` column: the rule on it fails every row."""
    books = td.books(spark, sf_dir).drop("title")
    fl = Q.flag(books, CONTRACTS["books"])
    return Q.rule_report(fl).withColumn("rule_index", F.col("rule_index").cast("long"))


# ---- reports and gate --------------------------------------------------------------------

@query("quality_rule_report", O.rule_report_sql())
def quality_rule_report(spark, sf_dir):
    return Chain(spark, sf_dir).rule_reports().withColumn("rule_index", F.col("rule_index").cast("long"))


@query("quality_dataset_report", O.dataset_report_sql())
def quality_dataset_report(spark, sf_dir):
    return Chain(spark, sf_dir).dataset_reports()


@query("quality_gate", O.with_chain(
    "SELECT coalesce(min(pass_rate), 1.0) AS worst_rate, 0.95 AS threshold, "
    "coalesce(min(pass_rate), 1.0) >= 0.95 AS gate_ok, count(*) AS n_datasets FROM (\n"
    + O.dataset_report_body() + ") d"))
def quality_gate(spark, sf_dir):
    return Q.quality_gate(Chain(spark, sf_dir).dataset_reports())


# ---- valid / quarantine split -----------------------------------------------------------------

@query("valid_rows", O.with_chain(
    "SELECT loan_id, reader_id, book_id, loan_date, l_suppkey, l_extendedprice, l_quantity "
    "FROM f_loans WHERE NOT " + O.any_failed(5)))
def valid_rows(spark, sf_dir):
    fl = Chain(spark, sf_dir).flagged("loans")
    return fl.valid().select(*fl.public_columns())


@query("quarantine_rows", O.with_chain(O.quarantine_rows_body(SILVER_REASON)))
def quarantine_rows(spark, sf_dir):
    ch = Chain(spark, sf_dir)
    ch.flag_all()
    return _union(quarantine_view(ch.flagged(ds), SILVER_REASON) for ds in ALL_DATASETS)


# ---- Silver ---------------------------------------------------------------------------

@query("silver_readers", O.with_chain("SELECT * FROM s_readers"))
def silver_readers(spark, sf_dir):
    return Chain(spark, sf_dir).silver("readers")


@query("silver_books", O.with_chain("SELECT * FROM s_books"))
def silver_books(spark, sf_dir):
    return Chain(spark, sf_dir).silver("books")


@query("silver_loans", O.with_chain("SELECT * FROM s_loans"))
def silver_loans(spark, sf_dir):
    return Chain(spark, sf_dir).silver("loans")


@query("silver_ratings", O.with_chain("SELECT * FROM s_ratings"))
def silver_ratings(spark, sf_dir):
    return Chain(spark, sf_dir).silver("ratings")


@query("silver_events", O.with_chain("SELECT * FROM s_events"))
def silver_events(spark, sf_dir):
    return Chain(spark, sf_dir).silver("access_events")


@query("silver_dates", O.with_chain(
    "SELECT reader_id, signup_date AS signup_text, "
    "strftime(try_strptime(signup_date, '%Y-%m-%d'), '%Y-%m-%d %H:%M:%S') AS signup_ts FROM a_readers"))
def silver_dates(spark, sf_dir):
    r = td.readers(spark, sf_dir).select("reader_id", F.col("signup_date").alias("signup_text"),
                                         F.col("signup_date"))
    # parsed value rendered as canonical text (year 2999 overflows pandas' ns timestamps)
    parsed = normalise_dates(r, CONTRACTS["readers"])
    return parsed.select("reader_id", "signup_text",
                         F.date_format("signup_date", "yyyy-MM-dd HH:mm:ss").alias("signup_ts"))


@query("bronze_control_columns", O.with_chain(
    f"SELECT *, '{RUN_TS}' AS _ingested_at, 'raw/readers' AS _source, '{RUN_ID}' AS run_id FROM a_readers"))
def bronze_control_columns(spark, sf_dir):
    return with_control_columns(td.readers(spark, sf_dir), "raw/readers", RUN_ID, RUN_TS).drop("_ordinal")


@query("silver_projection", O.with_chain("SELECT * FROM a_loans"))
def silver_projection(spark, sf_dir):
    bronze = with_control_columns(td.loans(spark, sf_dir), "raw/loans", RUN_ID, RUN_TS)
    return drop_control(bronze.drop("run_id"))


@query("dedup_keep_first", O.with_chain(
    "SELECT loan_id, reader_id, book_id, loan_date, l_suppkey, l_extendedprice, l_quantity FROM ("
    "SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY loan_date NULLS FIRST, l_suppkey NULLS FIRST, "
    "l_extendedprice NULLS FIRST, book_id NULLS FIRST, l_quantity NULLS FIRST) AS rn FROM a_loans) t WHERE rn = 1"))
def dedup_keep_first_q(spark, sf_dir):
    loans = td.loans(spark, sf_dir)
    return dedup_keep_first(loans, "loan_id", list(CONTRACTS["loans"].order_by)).drop("_ordinal")


@query("bronze_first_per_key", O.with_chain(
    "SELECT 'readers' AS dataset, CAST(reader_id AS VARCHAR) AS row_key, count(*) AS n_rows FROM a_readers "
    "WHERE reader_id IS NOT NULL GROUP BY reader_id UNION ALL "
    "SELECT 'books', CAST(book_id AS VARCHAR), count(*) FROM a_books WHERE book_id IS NOT NULL GROUP BY book_id UNION ALL "
    "SELECT 'loans', CAST(loan_id AS VARCHAR), count(*) FROM a_loans WHERE loan_id IS NOT NULL GROUP BY loan_id UNION ALL "
    "SELECT 'ratings', CAST(rating_id AS VARCHAR), count(*) FROM a_ratings WHERE rating_id IS NOT NULL GROUP BY rating_id"))
def bronze_first_per_key(spark, sf_dir):
    """By arrival order alone one row of each key stays, and all its rows are accounted for."""
    frames = []
    for ds in BATCH_DATASETS:
        key = CONTRACTS[ds].key
        rows = td.ADAPTERS[ds](spark, sf_dir, {key}).where(F.col(key).isNotNull())
        n = rows.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n_rows"))
        first = dedup_keep_first(rows, key, [])
        frames.append(first.join(n, first[key] == n["k"]).select(
            F.lit(ds).alias("dataset"), F.col(key).cast("string").alias("row_key"), "n_rows"))
    return _union(frames)


@query("ingest_report", O.ingest_report_sql())
def ingest_report(spark, sf_dir):
    """What ingest reports: per batch dataset, against raw references, rows, invalid rows and rate."""
    return Chain(spark, sf_dir).dataset_reports(BATCH_DATASETS).select(
        "dataset", "total_rows", "invalid_rows", "pass_rate_4dp")


@query("fk_orphans", O.with_chain(
    "SELECT 'loans' AS dataset, 'reader_id' AS \"column\", reader_id AS orphan_key, count(*) AS n_rows "
    "FROM f_loans WHERE r2 GROUP BY reader_id UNION ALL "
    "SELECT 'loans', 'book_id', book_id, count(*) FROM f_loans WHERE r3 GROUP BY book_id UNION ALL "
    "SELECT 'ratings', 'reader_id', reader_id, count(*) FROM f_ratings WHERE r3 GROUP BY reader_id UNION ALL "
    "SELECT 'ratings', 'book_id', book_id, count(*) FROM f_ratings WHERE r4 GROUP BY book_id"))
def fk_orphans(spark, sf_dir):
    """Rows per orphan key: a dataset is flagged by its foreign keys and read once for all of them."""
    ch = Chain(spark, sf_dir)
    frames = []
    for ds in ("loans", "ratings"):
        fl = ch.violations(ds, "fk")
        broken = [F.when(F.col(fl.flag_cols[i]), F.struct(F.lit(r.column).alias("column"), F.col(r.column).alias("orphan_key")))
                  for i, r in enumerate(fl.rules) if r.kind == "fk"]
        frames.append(fl.df.select(F.explode(F.array_compact(F.array(*broken))).alias("b")).groupBy("b.column", "b.orphan_key")
                      .agg(F.count(F.lit(1)).alias("n_rows"))
                      .select(F.lit(ds).alias("dataset"), "column", "orphan_key", "n_rows"))
    return _union(frames)


# ---- personal data -----------------------------------------------------------------------

@query("pii_pseudonym", O.with_chain(
    f"SELECT reader_id, {O.pseudonym_sql('name')} AS name_pseudo FROM a_readers"))
def pii_pseudonym(spark, sf_dir):
    r = td.readers(spark, sf_dir)
    return r.select("reader_id", pseudonym(F.col("name"), TEST_SALT).alias("name_pseudo"))


@query("pii_email_mask", O.with_chain(
    f"SELECT reader_id, email, {O.mask_email_sql('email')} AS email_masked FROM a_readers"))
def pii_email_mask(spark, sf_dir):
    r = td.readers(spark, sf_dir)
    return r.select("reader_id", "email", mask_email(F.col("email")).alias("email_masked"))


@query("json_decode_events", O.with_chain(
    "SELECT CAST(event_id AS VARCHAR) AS event_id, props, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS book_id FROM events"))
def json_decode_events(spark, sf_dir):
    ev = td.table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").cast("string").alias("event_id"), "props",
                     td.decode_props(F.col("props")).alias("book_id"))


# ---- Gold ---------------------------------------------------------------------------------

GOLD_SQL = {
    "top_books": "SELECT b.book_id, b.title, b.genre, count(l.loan_id) AS total_loans FROM s_loans l "
                 "JOIN s_books b ON b.book_id = l.book_id GROUP BY b.book_id, b.title, b.genre "
                 "ORDER BY total_loans DESC, b.book_id LIMIT 20",
    "usage_by_genre": "SELECT b.genre, count(l.loan_id) AS total_loans FROM s_loans l "
                      "JOIN s_books b ON b.book_id = l.book_id GROUP BY b.genre ORDER BY total_loans DESC",
    "rating_by_book": "SELECT b.book_id, b.title, b.genre, floor(avg(r.rating) * 100 + 0.5) / 100 AS avg_rating, "
                      "count(r.rating_id) AS n_ratings FROM s_ratings r JOIN s_books b ON b.book_id = r.book_id "
                      "GROUP BY b.book_id, b.title, b.genre HAVING count(r.rating_id) >= 5 "
                      "ORDER BY avg_rating DESC, n_ratings DESC, b.book_id LIMIT 20",
    "rating_distribution": "SELECT rating, count(*) AS total FROM s_ratings WHERE rating BETWEEN 1 AND 5 "
                           "GROUP BY rating ORDER BY rating",
    "loans_by_month": "SELECT strftime(loan_date, '%Y-%m') AS month, count(*) AS total_loans FROM s_loans "
                      "WHERE loan_date IS NOT NULL GROUP BY month ORDER BY month",
    "events_by_type": "SELECT event_type, count(*) AS total FROM s_events GROUP BY event_type ORDER BY total DESC",
    "kpis": "SELECT 'total_readers' AS metric, count(*) AS value FROM s_readers "
            "UNION ALL SELECT 'total_books', count(*) FROM s_books "
            "UNION ALL SELECT 'total_loans', count(*) FROM s_loans "
            "UNION ALL SELECT 'total_ratings', count(*) FROM s_ratings "
            "UNION ALL SELECT 'total_access_events', count(*) FROM s_events",
}

for _g, _sql in GOLD_SQL.items():
    def _mkg(name):
        return lambda spark, sf_dir: Chain(spark, sf_dir).gold(name)
    query(_g, O.with_chain(_sql))(_mkg(_g))


def _gold_cte(name: str) -> str:
    return f"g_{name} AS ({GOLD_SQL[name]})"


def _serving_sql(name: str, body: str) -> str:
    return "WITH " + O.ADAPTERS + "," + O.flags() + "," + O.silver() + ",\n" + _gold_cte(name) + "\n" + body


query("serving_top_books", _serving_sql(
    "top_books", "SELECT title, genre, total_loans FROM g_top_books ORDER BY total_loans DESC, book_id LIMIT 10"))(
    lambda spark, sf_dir: G.serving_top_books(Chain(spark, sf_dir).gold("top_books")))
query("serving_top_books_chart", _serving_sql(
    "top_books", "SELECT title, genre, total_loans FROM g_top_books ORDER BY total_loans DESC, book_id LIMIT 12"))(
    lambda spark, sf_dir: G.serving_top_books_chart(Chain(spark, sf_dir).gold("top_books")))
query("serving_genre_usage", _serving_sql(
    "usage_by_genre", "SELECT genre, total_loans FROM g_usage_by_genre"))(
    lambda spark, sf_dir: G.serving_genre_usage(Chain(spark, sf_dir).gold("usage_by_genre")))
query("serving_best_rated", _serving_sql(
    "rating_by_book", "SELECT title, avg_rating, n_ratings FROM g_rating_by_book "
                      "ORDER BY avg_rating DESC, n_ratings DESC, book_id LIMIT 10"))(
    lambda spark, sf_dir: G.serving_best_rated(Chain(spark, sf_dir).gold("rating_by_book")))
query("serving_events_by_type", _serving_sql(
    "events_by_type", "SELECT event_type, total FROM g_events_by_type"))(
    lambda spark, sf_dir: G.serving_events_by_type(Chain(spark, sf_dir).gold("events_by_type")))


@query("silver_stage_metrics", O.with_chain(
    "SELECT sum(total_rows) AS rows_in, sum(total_rows - invalid_rows) AS rows_out, "
    "sum(invalid_rows) AS quarantined, min(pass_rate) AS worst_rate FROM (\n"
    + O.dataset_report_body() + ") d"))
def silver_stage_metrics(spark, sf_dir):
    ch = Chain(spark, sf_dir)
    null_d = F.lit(None).cast("double")
    zero = F.lit(0).cast("long")
    rep = ch.dataset_reports().select("total_rows", "invalid_rows", "pass_rate", zero.alias("n_silver"))
    counts = [ch.silver(ds).agg(F.count(F.lit(1)).alias("n_silver"))
              .select(zero.alias("total_rows"), zero.alias("invalid_rows"), null_d.alias("pass_rate"),
                      "n_silver") for ds in ALL_DATASETS]
    return _union([rep] + counts).agg(
        F.sum("total_rows").cast("long").alias("rows_in"),
        F.sum("n_silver").cast("long").alias("rows_out"),
        F.sum("invalid_rows").cast("long").alias("quarantined"),
        F.min("pass_rate").alias("worst_rate"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}


# part two registers into the same dictionaries
from lakehold.plans import registry_more  # noqa: E402,F401
