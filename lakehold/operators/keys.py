"""Rules that need other rows: keep-first duplicates and foreign-key membership.

Neither uses a window over the key (a key holding a third of the rows would land in one task). A
partially aggregated key set is built first -- keys that occur more than once, or foreign keys
absent from the reference -- and joined back (see ``joins``). Key sets hold no more than the key and
the place of its first row, so the rows that meet them need not carry what orders them.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.operators.joins import Marks, join_keyset, key_set

DRAIN = "_drain"   # the micro-batch that landed a streamed row; row numbers begin anew in each
# where a row stood in its source: run, micro-batch, file (by name, as text), block of the file, row number
ARRIVAL = ("_arrival_run", DRAIN, "_file", "_block", "_ordinal")


def drain_of(df: DataFrame) -> Column:
    """The micro-batch of a row; empty for rows of batch sources."""
    return F.coalesce(F.col(DRAIN), F.lit("")) if DRAIN in df.columns else F.lit("")


def order_struct(columns: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def place_of(order: list[str]) -> list[str]:
    """The columns of ``order`` that say where a row stood, which identify it; all of them, where it
    has no position."""
    return [c for c in order if c in ARRIVAL] if "_ordinal" in order else list(order)


def with_position(df: DataFrame) -> DataFrame:
    """Rows numbered in scan order, where no stored position is present. ``df`` has to be a stored
    table or a scan: its rows must come in the same order each time it is read."""
    return df if "_ordinal" in df.columns else df.withColumn("_ordinal", F.monotonically_increasing_id())


def arrival_order(df: DataFrame, first: tuple = ()) -> list[str]:
    """Columns that order the rows of a key totally: ``first`` where present, then arrival."""
    return [c for c in (*first, *ARRIVAL) if c in df.columns]


SLOTS = 4096


def with_slot(keys: DataFrame) -> DataFrame:
    """A key set to be written, with the slot that its keys have in ``_spread``."""
    return keys.withColumn("_slot", F.lit(0))


def _spread(big: DataFrame, keys: DataFrame, key: str, by: list[str]):
    """A second join key for rows kept by an outer join: rows with a null key match nothing, but would
    all be shuffled to one partition; they are dealt over many, by a hash of ``by``. Equality with the
    written slot is no constant to the optimizer, so it stays a key of the shuffle."""
    if "_slot" not in keys.columns or not by:
        return F.lit(True)
    return F.when(big[key].isNull(), F.pmod(F.xxhash64(*[big[c] for c in by]), F.lit(SLOTS)) + 1).otherwise(0).cast("int") == keys["_slot"]


def _matches(key: str, nulls_equal: bool):
    return lambda big, keys: big[key].eqNullSafe(keys["_dk"]) if nulls_equal else big[key] == keys["_dk"]


def duplicate_keys(df: DataFrame, key: str, order: list[str], nulls_equal: bool = False) -> DataFrame:
    """Keys with more than one row and the place of the smallest order tuple (nulls first) per key.

    Rows are counted and their minimum is taken in one pass, aggregated in each task before the
    shuffle: every row moves once at most, and a hot key costs one row per task."""
    some = df if nulls_equal else df.where(F.col(key).isNotNull())
    firsts = some.groupBy(F.col(key).alias("_dk")).agg(F.count(F.lit(1)).alias("_dn"), F.min(order_struct(order)).alias("_dord"))
    return firsts.where("_dn > 1").select("_dk", F.struct(*[F.col(f"_dord.{c}") for c in place_of(order)]).alias("_dfirst"))


def repeated_keys(narrow: Callable[[set], DataFrame], key: str, order: list[str]) -> tuple[DataFrame, Marks]:
    """``duplicate_keys``, written, and marks over them. ``narrow(columns)`` gives the rows of a stored table with those
    columns. Keys alone are counted first; what orders rows only moves for keys that may have several."""
    counts = narrow({key}).where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_dk")).agg(F.count(F.lit(1)).alias("_dn"))
    marks = Marks.over(key_set(counts.where("_dn > 1").select("_dk")), "_dk")
    some = marks.on(narrow({key, *order}), key).where("_may")
    return key_set(with_slot(duplicate_keys(some, key, order))), marks


def first_rows(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows of ``df`` that are no duplicates: of each key the first by ``order``, which has to be total and
    end with the row's position, and every row with a null key.

    One shuffle finds the first and brings its columns; a hot key costs one row per task, and rows with a null
    key are told apart by their position."""
    own = F.when(F.col(key).isNull(), F.col("_ordinal"))
    carried = [c for c in df.columns if c not in order and c != key]
    firsts = df.groupBy(F.col(key), own.alias("_own")).agg(F.min(order_struct([*order, *carried])).alias("_first"))
    return firsts.select(*[F.col(c) if c == key else F.col(f"_first.{c}") for c in df.columns])


def with_duplicate_flag(df: DataFrame, key: str, order: list[str], flag: str,
                        nulls_equal: bool = False, dups: DataFrame | None = None, marks: Marks | None = None) -> DataFrame:
    """``flag`` is true for every row of a key except its first by ``order``, which has to be total
    (see ``arrival_order``); rows are told apart by ``place_of`` it. Null keys never fail unless ``nulls_equal`` (then nulls form one
    group). ``dups`` may carry the written key set, and ``marks`` those over it: rows without a mark stay out of the
    join; ``df`` is read twice then."""
    if marks is not None and not nulls_equal:
        marked = marks.on(df, key)
        # no null among them: the key alone deals them, which later groups by key may use
        met = with_duplicate_flag(marked.where("_may").drop("_may"), key, order, flag, dups=dups.drop("_slot"))
        return met.unionByName(marked.where("not _may").drop("_may").withColumn(flag, F.lit(False)))
    dups = dups if dups is not None else key_set(with_slot(duplicate_keys(df, key, order, nulls_equal)))
    same = _matches(key, nulls_equal)
    out = join_keyset(df, dups, same if nulls_equal else lambda big, keys: same(big, keys) & _spread(big, keys, key, place_of(order)))
    is_dup = F.col("_dfirst").isNotNull() & ~order_struct(place_of(order)).eqNullSafe(F.col("_dfirst"))
    return out.withColumn(flag, F.coalesce(is_dup, F.lit(False))).drop("_dk", "_dfirst", "_slot")


def dedup_keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep the first row per key by ``order``, then by position; null keys count as one key."""
    placed = with_position(df)
    order = [c for c in order if c not in ARRIVAL] + arrival_order(placed)
    kept = with_duplicate_flag(placed, key, order, "_is_dup", nulls_equal=True).where(~F.col("_is_dup"))
    return kept.select(*df.columns)


def orphan_keys(df: DataFrame, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """Distinct non-null values of ``column`` absent from the non-null reference keys."""
    key_type = df.schema[column].dataType
    keys = df.select(F.col(column).alias("_ok")).where(F.col("_ok").isNotNull()).distinct()
    ref_keys = (ref.select(F.col(ref_column).cast(key_type).alias("_ok"))
                .where(F.col("_ok").isNotNull()).distinct())
    return keys.join(ref_keys, "_ok", "left_anti")


def with_fk_flag(df: DataFrame, column: str, orphans: DataFrame | None, flag: str, by: tuple = ()) -> DataFrame:
    """``flag`` is true when ``column`` holds one of ``orphans``; null passes, and rows with it are
    dealt by the columns ``by``."""
    if orphans is None:
        return df.withColumn(flag, F.lit(False))
    named = orphans.withColumn("_orphan", F.lit(True))
    by = [c for c in by if c in df.columns]
    out = join_keyset(df, named, lambda big, keys: (big[column] == keys["_ok"]) & _spread(big, keys, column, by))
    return out.withColumn(flag, F.coalesce(F.col("_orphan"), F.lit(False))).drop("_ok", "_orphan", "_slot")
