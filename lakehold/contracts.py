"""Data contracts: declared schema, personal-data columns, quality rules, keep-first order.

A contract is plain data. ``rules`` turns each rule into a Spark Column (see
``lakehold.functions.rules``); nothing here touches Spark, so contracts load and
validate on the driver before any job starts.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay as they are for results to match the behaviour
# being reproduced (rule names, e-mail pattern, thresholds, ranking sizes).
# ---------------------------------------------------------------------------
RULE_KINDS = ("not_null", "unique", "in_set", "in_range", "regex", "not_future", "fk")
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
QUALITY_GATE_MIN_PASS_RATE = 0.95      # gate: worst dataset rate strictly below -> blocked
QUALITY_ALERT_PASS_RATE = 0.99         # health: below -> alert
VOLUME_DRIFT_TOLERANCE = 0.50          # |now - prev| / prev strictly above -> WARN
FRESHNESS_MAX_HOURS = 26.0             # health: last run older -> alert
MIN_RATINGS_PER_BOOK = 5               # HAVING COUNT >= 5
TOP_N = 20                             # Gold rankings
SERVING_TOP_N = 10                     # serving queries
DASHBOARD_TOP_N = 12                   # dashboard chart
PSEUDONYM_HEX_CHARS = 16               # first 16 hex chars of SHA-256(salt + value)
MISSING_COLUMN_DETAIL = "column missing"
SILVER_REASON = "rejected_silver"
REPROCESS_REASON = "still_invalid_after_reprocess"
REPROCESS_SOURCE = "reprocess"
CORRUPT_RULE = "well_formed:_corrupt_record"   # a source line with the wrong number of fields
GENRES = ("Romance", "Ficcao Cientifica", "Fantasia", "Tecnico", "Biografia", "Historia", "Infantil", "Poesia")
EVENT_TYPES = ("busca", "clique", "visualizacao")
YEAR_RANGE = (1450, 2026)
RATING_RANGE = (1, 5)
# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------

# declared type -> Spark type. ``date`` stays text until Silver parses it.
DECLARED_TYPES = {
    "int": T.LongType(),
    "string": T.StringType(),
    "date": T.StringType(),
    "timestamp": T.StringType(),
    "double": T.DoubleType(),
}


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str
    param: object = None

    def __post_init__(self):
        if self.kind not in globals()["RULE_KINDS"]:
            raise ValueError(f"unknown rule kind {self.kind!r} on column {self.column!r}")
        if self.kind == "in_range" and len(self.param) != 2:
            raise ValueError("in_range needs (lo, hi)")
        if self.kind == "fk" and len(self.param) != 2:
            raise ValueError("fk needs (dataset, column)")

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"

    @property
    def detail(self) -> str:
        """Parameter rendered as text for the rule report."""
        if self.param is None:
            return ""
        if self.kind == "in_set":
            return ",".join(str(v) for v in self.param)
        if self.kind == "in_range":
            return f"{self.param[0]}..{self.param[1]}"
        if self.kind == "fk":
            return f"{self.param[0]}.{self.param[1]}"
        return str(self.param)


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple                       # ((column, declared type), ...)
    rules: tuple                         # (Rule, ...)
    pii: dict = field(default_factory=dict)            # personal-data column -> policy (functions.privacy)
    order_by: tuple = ()                 # keep-first order before arrival; empty: arrival alone
    date_formats: dict = field(default_factory=dict)   # column -> parse pattern
    about: dict = field(default_factory=dict)          # governance facts: domain, owner, origin, format, frequency, latency
    stream: bool = False

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def key(self) -> str | None:
        """Column of the first ``unique`` rule (dedup key)."""
        return next((r.column for r in self.rules if r.kind == "unique"), None)

    @property
    def row_key(self) -> str:
        """Column that identifies a row in reports: the unique key, else the first column."""
        return self.key or self.columns[0][0]

    def spark_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, DECLARED_TYPES[t], True) for c, t in self.columns])

    def dedup_is_noop(self) -> bool:
        """Keep-first dedup cannot remove anything from rows that passed not_null+unique on the key."""
        key = self.key
        return key is not None and any(r.kind == "not_null" and r.column == key for r in self.rules)


def _rules(*items) -> tuple:
    return tuple(Rule(*i) for i in items)


def _about(domain: str, owner: str, origin: str, layout: str, frequency: str, latency: str) -> dict:
    return {"domain": domain, "owner": owner, "origin": origin, "format": layout, "frequency": frequency, "latency": latency}


CONTRACTS: dict[str, Contract] = {c.name: c for c in (
    Contract(
        name="readers",
        columns=(("reader_id", "int"), ("name", "string"), ("email", "string"),
                 ("city", "string"), ("signup_date", "date")),
        pii={"name": "pseudonym_column", "email": "mask_email"},
        rules=_rules(("not_null", "reader_id"), ("unique", "reader_id"),
                     ("not_null", "email"), ("regex", "email", EMAIL_PATTERN),
                     ("not_future", "signup_date")),
        date_formats={"signup_date": "yyyy-MM-dd"},
        about=_about("people", "lake team", "raw/readers", "text with a header line", "with every run", "one run"),
    ),
    Contract(
        name="books",
        columns=(("book_id", "int"), ("title", "string"), ("author", "string"),
                 ("isbn", "string"), ("genre", "string"), ("publisher", "string"),
                 ("year", "int")),
        rules=_rules(("not_null", "book_id"), ("unique", "book_id"),
                     ("not_null", "title"), ("in_range", "year", YEAR_RANGE),
                     ("in_set", "genre", GENRES)),
        about=_about("titles", "lake team", "raw/books", "text with a header line", "with every run", "one run"),
    ),
    Contract(
        name="loans",
        columns=(("loan_id", "int"), ("reader_id", "int"), ("book_id", "int"),
                 ("loan_date", "date"), ("return_date", "date")),
        rules=_rules(("not_null", "loan_id"), ("unique", "loan_id"),
                     ("fk", "reader_id", ("readers", "reader_id")),
                     ("fk", "book_id", ("books", "book_id")),
                     ("not_future", "loan_date")),
        date_formats={"loan_date": "yyyy-MM-dd", "return_date": "yyyy-MM-dd"},
        about=_about("activity", "lake team", "raw/loans", "text with a header line", "with every run", "one run"),
    ),
    Contract(
        name="ratings",
        columns=(("rating_id", "int"), ("reader_id", "int"), ("book_id", "int"),
                 ("rating", "int"), ("comment", "string"), ("rating_date", "date")),
        rules=_rules(("not_null", "rating_id"), ("unique", "rating_id"),
                     ("in_range", "rating", RATING_RANGE),
                     ("fk", "reader_id", ("readers", "reader_id")),
                     ("fk", "book_id", ("books", "book_id"))),
        date_formats={"rating_date": "yyyy-MM-dd"},
        about=_about("activity", "lake team", "raw/ratings", "text with a header line", "with every run", "one run"),
    ),
    Contract(
        name="access_events",
        columns=(("event_id", "string"), ("reader_id", "int"), ("event_type", "string"),
                 ("book_id", "int"), ("event_ts", "timestamp")),
        rules=_rules(("not_null", "event_id"), ("in_set", "event_type", EVENT_TYPES)),
        date_formats={"event_ts": None},   # ISO timestamps, fractions allowed
        about=_about("activity", "lake team", "event queue", "JSON lines", "whenever drained", "one micro-batch"),
        stream=True,
    ),
)}

BATCH_DATASETS = ("readers", "books", "loans", "ratings")
STREAM_DATASETS = ("access_events",)
ALL_DATASETS = BATCH_DATASETS + STREAM_DATASETS


def contract(name: str) -> Contract:
    try:
        return CONTRACTS[name]
    except KeyError:
        raise KeyError(f"unknown dataset {name!r}; known: {', '.join(CONTRACTS)}") from None


def fk_targets(c: Contract) -> set[str]:
    return {r.param[0] for r in c.rules if r.kind == "fk"}
