"""Personal data, and the terms around it that disclose it: information-theoretic sanitisation.

Everything is Column and DataFrame work; no Python runs on the executors.

*Base.* E-mail addresses, IP addresses, card and phone numbers by pattern, with their positions in code
points. The patterns are stated so that matching is linear in the text: quantifiers that cannot gain by giving back
are possessive, and a match that could only repeat a failed one is not begun (``\\G`` admits the place where the last
match ended).

*Disclosure.* Each distinct address or number is a protected entity e. The terms t of its context are up to
``WINDOW`` words on either side, not across another match. Over the distinct texts of the corpus (copies are no evidence)

    information of e     IC(e)    = log2(N / df(e))
    shared information   PMI(t,e) = log2(df(t,e) N / (df(t) df(e)))

with N texts, df(e) of them with e, df(t) with t anywhere, df(t,e) with t in a context of e. The term discloses the share
PMI / IC of what there is to know about e: 1 where it occurs with e only. From ``generalise_at`` on a term in a context
of e is generalised (``<name>`` if capitalised, else ``<word>``), from ``remove_at`` on removed. Pairs seen in
fewer than ``support`` texts are no estimate and are left alone.

*At size.* One pass finds spans and contexts; statistics run over the contexts, which are few per entity, so a hot
entity is many small rows. Only terms that may disclose something are counted in the corpus.

Defined cases. Null texts are empty. Rows that repeat a doc_id are judged each by its own text; rows equal in
doc_id and text have the same spans. Null ids are kept. Texts without personal data have no spans. Kinds may overlap; terms
are looked for between matches. Very long texts are whole. Texts count as equal by a hash of 64 bits, in the statistics
only. Empty tables give no rows; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.llm._base import fresh
from lakehold.sources.scratch import materialise

WINDOW, SUPPORT, GENERALISE_AT, REMOVE_AT = 8, 3, 0.85, 0.95
REACH, RUN = 300, 256  # code points looked at for a context; matches per step of the running sum

KINDS = ["email", "ip", "card", "phone"]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?+[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
SPAN = "array<struct<start:int,end:int,value:string>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def placed(text: Column, pattern: str) -> Column:
    """All matches, leftmost and not overlapping: start, end (code points, end exclusive) and value.

    Starts are running sums over the pieces between matches, taken in runs of ``RUN`` matches, so that appending does
    not cost the square of their number.
    """
    def step(s: Column, m: Column) -> Column:
        start = s["at"] + m["gap"]
        end = start + F.length(m["value"])
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(F.struct(start.alias("start"), end.alias("end"), m["value"].alias("value")))).alias("out"))

    def positions(matches: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(matches) - 1, F.lit(RUN)), lambda first: F.slice(matches, first + 1, RUN))
        none = F.array().cast(SPAN)
        whole = F.aggregate(runs, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")), lambda s, run: let(
            F.aggregate(run, F.struct(s["at"].alias("at"), none.alias("out")), step),
            lambda r: F.struct(r["at"].alias("at"), F.concat(s["out"], F.array(r["out"])).alias("out"))))
        return F.when(F.size(matches) > 0, F.flatten(whole["out"])).otherwise(none)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, let(
        F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found,
                   lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value"))), positions)).otherwise(F.array().cast(SPAN)))


# ---- base -------------------------------------------------------------------------------------

def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(s: Column, i: Column) -> Column:
        x = F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * (2 - i % 2)
        return s + F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def genuine(kind: str, value: Column) -> Column:
    """Whether a match counts."""
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _of_kind(kind: str, matches: Column) -> Column:
    return F.filter(matches, lambda m: genuine(kind, m["value"]))


def base_spans(text: Column) -> list[Column]:
    """Per kind the genuine matches of a text."""
    none = F.array().cast(SPAN)
    mark = {"email": "@", "ip": ".", "phone": "+"}  # texts without it have no match
    out = []
    for kind, pattern in zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True):
        found = _of_kind(kind, placed(text, pattern))
        out.append(F.when(F.contains(text, F.lit(mark[kind])), found).otherwise(none) if kind in mark else found)
    return out


def ordered(spans: list[tuple[int, Column]]) -> Column:
    """Spans of several kinds, as (start, kind, end) by start, then kind."""
    def numbered(kind: int, matches: Column) -> Column:
        return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))

    return F.array_sort(F.concat(*[numbered(k, a) for k, a in spans]))


ALL_KINDS = [*KINDS, "remove", "generalise"]


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, ALL_KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


# ---- contexts ---------------------------------------------------------------------------------

def _entity(value: Column) -> Column:
    """The normal form of a genuine match, else null."""
    email, phone, ip = F.contains(value, F.lit("@")), value.startswith("+"), value.rlike(r"^[0-9]+(?:\.[0-9]+){3}$")
    return (F.when(email, F.concat(F.lit("email:"), F.lower(value)))
            .when(phone, F.when(genuine("phone", value), F.concat(F.lit("phone:"), _digits(value))))
            .when(ip, F.when(genuine("ip", value), F.concat(F.lit("ip:"), value)))
            .when(genuine("card", value), F.concat(F.lit("card:"), _digits(value))))


def contexts(text: Column, window: int = WINDOW) -> Column:
    """Of each entity occurrence: the entity, and the terms on either side with their positions."""
    anything = "|".join(f"(?:{p})" for p in (EMAIL, PHONE, IP, CARD))

    def shift(words: Column, by: Column) -> Column:
        return F.transform(words, lambda w: F.struct(
            (w["start"] + by).alias("start"), (w["end"] + by).alias("end"), w["value"].alias("value")))

    def before(piece: Column, end: Column) -> Column:
        near = F.substring(F.concat(F.lit(" "), piece), F.lit(-(REACH + 1)), F.lit(REACH + 1))  # a word cut in two has no start here
        return let(near, lambda s: let(placed(s, r"(?<=\P{L})\p{L}{3,}+"), lambda w: shift(
            F.slice(w, F.greatest(F.size(w) - window, F.lit(0)) + 1, window), end - F.length(s))))

    def after(piece: Column, start: Column) -> Column:
        near = F.substring(F.concat(piece, F.lit(" ")), F.lit(1), F.lit(REACH + 1))
        return shift(F.slice(placed(near, r"\p{L}{3,}+(?=\P{L})"), 1, window), start)

    def of(pieces: Column, matches: Column) -> Column:
        return F.transform(matches, lambda m, i: F.struct(_entity(m["value"]).alias("entity"), F.concat(
            before(pieces[i], m["start"]), after(pieces[i + 1], m["end"])).alias("terms")))

    return let(F.struct(F.split(text, anything, -1).alias("pieces"), placed(text, anything).alias("matches")),
               lambda x: F.filter(of(x["pieces"], x["matches"]), lambda c: c["entity"].isNotNull() & (F.size(c["terms"]) > 0)))


def find(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, base (spans), contexts, and the number of spans of each kind: one row per document."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", text.alias("text")).withColumn("of", F.struct(*[
        a.alias(k) for k, a in zip(KINDS, base_spans(F.col("text")), strict=True)]))
    some = F.size("of.email") + F.size("of.ip") + F.size("of.card") + F.size("of.phone") > 0
    return found.select(
        "doc_id", F.xxhash64("text").alias("text_key"), *[F.size(f"of.{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        ordered([(i, F.col(f"of.{k}")) for i, k in enumerate(KINDS)]).alias("base"),
        F.when(some, contexts(F.col("text"), window)).alias("contexts"))


# ---- disclosure -------------------------------------------------------------------------------

def disclosing(docs: DataFrame, found: DataFrame, support: int = SUPPORT, least: float = GENERALISE_AT) -> DataFrame:
    """entity, term, share: the pairs whose term discloses ``least`` or more of the entity."""
    texts = float(found.select("text_key").distinct().count())
    known = F.log2(F.lit(texts) / F.col("df_e"))
    share = lambda df_t: F.log2(F.col("df_te") * F.lit(texts) / (F.col(df_t) * F.col("df_e"))) / known
    seen = found.select("text_key", F.explode("contexts").alias("c")).select("text_key", "c.entity", F.col("c.terms.value").alias("terms"))
    entities = seen.select("entity", "text_key").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("df_e"))
    near = seen.select("text_key", "entity", F.explode("terms").alias("term")).withColumn("term", F.lower("term"))
    together = near.distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("df_te")).where(F.col("df_te") >= support)
    # the texts with t in a context of any entity are a part of those with t: a term too frequent there is out
    around = near.select("text_key", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df_near"))
    pairs = materialise(together.join(entities, "entity").join(around, "term").where((known > 0) & (share("df_near") >= least)), "disclosure-pairs")
    asked = materialise(pairs.select("term").distinct(), "disclosure-terms")
    # only the terms asked for are counted; the join is a broadcast or a shuffle by the size of the written table
    words = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(
        F.xxhash64("text").alias("text_key"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}+"), F.lit(0)))).alias("term"))
    terms = words.join(asked, "term", "left_semi").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
    return pairs.join(terms, "term").select("entity", "term", share("df_t").alias("share")).where(F.col("share") >= least)


def scan(docs: DataFrame, window: int = WINDOW, support: int = SUPPORT, generalise_at: float = GENERALISE_AT,
         remove_at: float = REMOVE_AT) -> DataFrame:
    """doc_id, text_key, n_email, n_ip, n_card, n_phone, base, spans: (start, kind, end) arrays, one row per document."""
    found = materialise(find(docs, window), "disclosure-found")
    risky = materialise(disclosing(docs, found, support, generalise_at), "disclosure-risky")
    places = found.select("doc_id", "text_key", F.explode("contexts").alias("c")).select(
        "doc_id", "text_key", "c.entity", F.explode("c.terms").alias("t")).withColumn("term", F.lower("t.value"))
    kind = F.when(F.col("share") >= remove_at, len(KINDS)).otherwise(len(KINDS) + 1)
    # a place may stand in contexts of several entities: the stronger measure holds
    hits = places.join(risky, ["entity", "term"]).groupBy("doc_id", "text_key", "t.start", "t.end").agg(F.min(kind).alias("kind"))
    extra = hits.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("extra"))  # of one text
    extra = materialise(extra.withColumnRenamed("doc_id", "of_doc").withColumnRenamed("text_key", "of_key"), "disclosure-extra")
    joined = found.drop("contexts").join(extra, found["doc_id"].eqNullSafe(extra["of_doc"]) & (found["text_key"] == extra["of_key"]), "left")
    return joined.withColumn("spans", F.when(F.col("extra").isNull(), F.col("base")).otherwise(
        F.array_sort(F.concat("base", "extra")))).drop("extra", "of_doc", "of_key")


def report(docs: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans, and all spans written out."""
    return scan(docs).select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                             written(F.col("spans")).alias("spans"))


def sanitised(docs: DataFrame, scanned: DataFrame | None = None) -> DataFrame:
    """``docs`` with personal data replaced by ``<kind>``, disclosing terms generalised or removed.

    Overlapping spans are replaced as one, by the first's kind (by start, then kind).
    Null texts stay null.
    """
    key, doc, spans = (fresh(docs, c) for c in ("text_key", "of_doc", "spans"))
    found = (scan(docs) if scanned is None else scanned).select(F.col("doc_id").alias(doc), F.col("text_key").alias(key), F.col("spans").alias(spans))
    text = F.coalesce(docs["text"], F.lit(""))
    joined = docs.join(found.distinct(), docs["doc_id"].eqNullSafe(found[doc]) & (F.xxhash64(text) == found[key]))
    label = F.array(*[F.lit(f"<{k}>") for k in KINDS], F.lit(""))

    def step(s: Column, span: Column) -> Column:
        word = F.substring(F.col("text"), span["start"] + 1, F.lit(1))
        put = F.when(span["kind"] <= len(KINDS), F.element_at(label, F.least(span["kind"], F.lit(len(KINDS))) + 1)).otherwise(
            F.when(word != F.lower(word), F.lit("<name>")).otherwise(F.lit("<word>")))
        kept = F.substring(F.col("text"), s["at"] + 1, span["start"] - s["at"])
        beyond = F.struct(F.greatest(s["at"], span["end"]).alias("at"), s["out"].alias("out"))
        return F.when(span["start"] < s["at"], beyond).otherwise(F.struct(span["end"].alias("at"), F.concat(s["out"], F.array(kept, put)).alias("out")))

    whole = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    return joined.withColumn("text", whole).select(*docs.columns)
