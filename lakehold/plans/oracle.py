"""DuckDB SQL for the correctness cross-check: the same queries written independently
as plain SQL (join-then-group, window row_number for keep-first, NOT IN for fk).

The adapter views mirror ``lakehold.sources.testdata``; flags mirror the contracts.
"""
from __future__ import annotations

from lakehold.contracts import EMAIL_PATTERN
from lakehold.functions.privacy import TEST_SALT
from lakehold.sources.testdata import EVENT_TYPES, GENRES


def _q(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


ADAPTERS = """
a_readers AS (
  SELECT CASE WHEN c_custkey % 257 = 10 THEN NULL ELSE c_custkey END AS reader_id, c_name AS name,
    CASE WHEN c_custkey % 97 = 5 THEN concat('c', c_custkey, '_at_ex.com')
         WHEN c_custkey % 89 = 7 THEN NULL
         ELSE concat(lower(replace(c_name, '#', '.')), '@ex', c_nationkey, '.com') END AS email,
    n_name AS city,
    CASE WHEN c_custkey % 101 = 3 THEN 'not-a-date'
         WHEN c_custkey % 103 = 4 THEN '2999-01-01'
         ELSE concat(2019 + c_custkey % 3, '-', lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0'),
                     '-', lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0')) END AS signup_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey CROSS JOIN (VALUES (0), (1)) d(copy)
  WHERE copy = 0 OR c_custkey % 251 = 9),
a_books AS (
  SELECT CASE WHEN p_partkey % 263 = 12 THEN NULL ELSE p_partkey END AS book_id, p_name AS title, p_brand AS author, p_type AS genre,
    CAST(CASE WHEN p_partkey % 83 = 2 THEN 3000 ELSE 1950 + p_partkey % 77 END AS BIGINT) AS year
  FROM part CROSS JOIN (VALUES (0), (1)) d(copy) WHERE copy = 0 OR p_partkey % 241 = 11),
a_loans AS (
  SELECT CASE WHEN l_orderkey % 307 = 5 THEN NULL ELSE l_orderkey * 8 + l_linenumber END AS loan_id,
    CASE WHEN l_orderkey % 100 = 1 THEN o_custkey + 1000000 ELSE o_custkey END AS reader_id,
    CASE WHEN l_orderkey % 91 = 2 THEN NULL WHEN l_orderkey % 113 = 7 THEN l_partkey + 10000000 ELSE l_partkey END AS book_id,
    l_shipdate AS loan_date, l_suppkey, l_extendedprice, l_quantity
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey CROSS JOIN (VALUES (0), (1)) d(copy)
  WHERE copy = 0 OR l_orderkey % 211 = 3),
a_ratings AS (
  SELECT CASE WHEN l_orderkey % 311 = 6 THEN NULL ELSE l_orderkey * 8 + l_linenumber END AS rating_id,
    CASE WHEN l_orderkey % 100 = 2 THEN o_custkey + 1000000 ELSE o_custkey END AS reader_id,
    CASE WHEN l_orderkey % 127 = 9 THEN l_partkey + 10000000 ELSE l_partkey END AS book_id,
    CAST(l_quantity AS BIGINT) % 7 AS rating, l_shipdate AS rating_date, l_suppkey, l_extendedprice
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey CROSS JOIN (VALUES (0), (1)) d(copy)
  WHERE copy = 0 OR l_orderkey % 199 = 4),
a_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, user_id AS reader_id, event_type,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS book_id, ts AS event_ts, props
  FROM events)"""


def flags(as_of_loans: str = "2001-01-01 00:00:00", as_of_readers: str = "2026-01-01 00:00:00") -> str:
    return f"""
f_readers AS (
  SELECT *,
    reader_id IS NULL AS r0,
    reader_id IS NOT NULL AND rk > 1 AS r1,
    email IS NULL AS r2,
    email IS NOT NULL AND NOT regexp_matches(email, '{EMAIL_PATTERN}') AS r3,
    coalesce(try_strptime(signup_date, '%Y-%m-%d') > TIMESTAMP '{as_of_readers}', false) AS r4
  FROM (SELECT *, row_number() OVER (PARTITION BY reader_id ORDER BY reader_id) AS rk FROM a_readers) t),
f_books AS (
  SELECT *,
    book_id IS NULL AS r0,
    book_id IS NOT NULL AND rk > 1 AS r1,
    title IS NULL AS r2,
    year IS NOT NULL AND (year < 1450 OR year > 2026) AS r3,
    genre IS NOT NULL AND genre NOT IN ({_q(GENRES)}) AS r4
  FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY book_id) AS rk FROM a_books) t),
f_loans AS (
  SELECT *,
    loan_id IS NULL AS r0,
    loan_id IS NOT NULL AND rk > 1 AS r1,
    reader_id IS NOT NULL AND reader_id NOT IN (SELECT reader_id FROM a_readers WHERE reader_id IS NOT NULL) AS r2,
    book_id IS NOT NULL AND book_id NOT IN (SELECT book_id FROM a_books WHERE book_id IS NOT NULL) AS r3,
    coalesce(loan_date > TIMESTAMP '{as_of_loans}', false) AS r4
  FROM (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY loan_date NULLS FIRST,
      l_suppkey NULLS FIRST, l_extendedprice NULLS FIRST, book_id NULLS FIRST, l_quantity NULLS FIRST) AS rk FROM a_loans) t),
f_ratings AS (
  SELECT *,
    rating_id IS NULL AS r0,
    rating_id IS NOT NULL AND rk > 1 AS r1,
    rating IS NOT NULL AND (rating < 1 OR rating > 5) AS r2,
    reader_id IS NOT NULL AND reader_id NOT IN (SELECT reader_id FROM a_readers WHERE reader_id IS NOT NULL) AS r3,
    book_id IS NOT NULL AND book_id NOT IN (SELECT book_id FROM a_books WHERE book_id IS NOT NULL) AS r4
  FROM (SELECT *, row_number() OVER (PARTITION BY rating_id ORDER BY rating_date NULLS FIRST,
      l_suppkey NULLS FIRST, l_extendedprice NULLS FIRST) AS rk FROM a_ratings) t),
f_events AS (
  SELECT *, 1 AS rk,
    event_id IS NULL AS r0,
    event_type IS NOT NULL AND event_type NOT IN ({_q(EVENT_TYPES)}) AS r1
  FROM a_events)"""


def mask_email_sql(col: str) -> str:
    at = f"strpos({col}, '@')"
    return (f"CASE WHEN {at} > 0 THEN left({col}, least({at} - 1, 2)) || "
            f"repeat('*', greatest({at} - 3, 1)) || substr({col}, {at}) ELSE {col} END")


def pseudonym_sql(col: str, salt: str = TEST_SALT) -> str:
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE substr(sha256('{salt}' || CAST({col} AS VARCHAR)), 1, 16) END"


def silver(salt: str = TEST_SALT) -> str:
    return f"""
s_readers AS (
  SELECT reader_id, {mask_email_sql('email')} AS email, city,
    try_strptime(signup_date, '%Y-%m-%d') AS signup_date, {pseudonym_sql('name', salt)} AS name_pseudo
  FROM f_readers WHERE NOT (r0 OR r1 OR r2 OR r3 OR r4)),
s_books AS (
  SELECT book_id, title, author, genre, year FROM f_books WHERE NOT (r0 OR r1 OR r2 OR r3 OR r4)),
s_loans AS (
  SELECT loan_id, reader_id, book_id, loan_date, l_suppkey, l_extendedprice, l_quantity
  FROM f_loans WHERE NOT (r0 OR r1 OR r2 OR r3 OR r4)),
s_ratings AS (
  SELECT rating_id, reader_id, book_id, rating, rating_date, l_suppkey, l_extendedprice
  FROM f_ratings WHERE NOT (r0 OR r1 OR r2 OR r3 OR r4)),
s_events AS (
  SELECT event_id, reader_id, event_type, book_id, event_ts, props FROM f_events WHERE NOT (r0 OR r1))"""


def with_chain(body: str, *, as_of_loans: str = "2001-01-01 00:00:00") -> str:
    return "WITH " + ADAPTERS + "," + flags(as_of_loans) + "," + silver() + "\n" + body


# rule metadata per flags CTE: (dataset, cte, key, [(kind, column, detail), ...])
RULES = [
    ("readers", "f_readers", "reader_id", [("not_null", "reader_id", ""), ("unique", "reader_id", ""),
                                           ("not_null", "email", ""), ("regex", "email", EMAIL_PATTERN),
                                           ("not_future", "signup_date", "")]),
    ("books", "f_books", "book_id", [("not_null", "book_id", ""), ("unique", "book_id", ""),
                                     ("not_null", "title", ""), ("in_range", "year", "1450..2026"),
                                     ("in_set", "genre", ",".join(GENRES))]),
    ("loans", "f_loans", "loan_id", [("not_null", "loan_id", ""), ("unique", "loan_id", ""),
                                     ("fk", "reader_id", "readers.reader_id"),
                                     ("fk", "book_id", "books.book_id"),
                                     ("not_future", "loan_date", "")]),
    ("ratings", "f_ratings", "rating_id", [("not_null", "rating_id", ""), ("unique", "rating_id", ""),
                                           ("in_range", "rating", "1..5"),
                                           ("fk", "reader_id", "readers.reader_id"),
                                           ("fk", "book_id", "books.book_id")]),
    ("access_events", "f_events", "event_id", [("not_null", "event_id", ""),
                                               ("in_set", "event_type", ",".join(EVENT_TYPES))]),
]


def any_failed(n: int) -> str:
    return "(" + " OR ".join(f"r{i}" for i in range(n)) + ")"


def rule_report_sql() -> str:
    parts = []
    for ds, cte, _, rules in RULES:
        for i, (kind, col, detail) in enumerate(rules):
            parts.append(
                f"SELECT '{ds}' AS dataset, CAST({i} AS BIGINT) AS rule_index, '{kind}' AS rule, "
                f"'{col}' AS \"column\", count(*) FILTER (WHERE NOT r{i}) AS passed, "
                f"count(*) FILTER (WHERE r{i}) AS failed, '{detail}' AS detail FROM {cte}")
    return with_chain("\nUNION ALL\n".join(parts))


def dataset_report_body() -> str:
    parts = []
    for ds, cte, _, rules in RULES:
        n = len(rules)
        parts.append(
            f"SELECT '{ds}' AS dataset, count(*) AS total_rows, "
            f"count(*) FILTER (WHERE {any_failed(n)}) AS invalid_rows, "
            f"CASE WHEN count(*) = 0 THEN 1.0 ELSE CAST(count(*) - count(*) FILTER (WHERE {any_failed(n)}) AS DOUBLE) / count(*) END AS pass_rate, "
            f"count(*) FILTER (WHERE {any_failed(n)}) = 0 AS passed FROM {cte}")
    return "\nUNION ALL\n".join(parts)


def dataset_report_sql() -> str:
    return with_chain(
        "SELECT dataset, total_rows, invalid_rows, pass_rate, "
        "floor(pass_rate * 10000 + 0.5) / 10000 AS pass_rate_4dp, passed FROM (\n"
        + dataset_report_body() + ") d")


def ingest_report_sql() -> str:
    return with_chain("SELECT dataset, total_rows, invalid_rows, floor(pass_rate * 10000 + 0.5) / 10000 AS pass_rate_4dp FROM (\n"
                      + dataset_report_body() + ") d WHERE dataset <> 'access_events'")


def failed_rules_sql(rules) -> str:
    return "concat_ws(',', " + ", ".join(
        f"CASE WHEN r{i} THEN '{kind}:{col}' END" for i, (kind, col, _) in enumerate(rules)) + ")"


def quarantine_rows_body(reason: str) -> str:
    parts = []
    for ds, cte, key, rules in RULES:
        parts.append(
            f"SELECT '{ds}' AS dataset, CAST({key} AS VARCHAR) AS row_key, "
            f"{failed_rules_sql(rules)} AS failed_rules, '{reason}' AS reason "
            f"FROM {cte} WHERE {any_failed(len(rules))}")
    return "\nUNION ALL\n".join(parts)
