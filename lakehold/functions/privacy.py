"""Personal-data policies as native Column expressions (no Python UDF)."""
from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.contracts import PSEUDONYM_HEX_CHARS, Contract

TEST_SALT = "lakehold-pii-salt"   # of the queries over the test tables only


def salt() -> str:
    """The secret of this installation; pseudonyms under a known salt could be guessed."""
    if not os.environ.get("PII_SALT"):
        raise RuntimeError("set PII_SALT: pseudonyms need a secret salt")
    return os.environ["PII_SALT"]


def pseudonym(c: Column, salt_value: str | None = None) -> Column:
    """First 16 hex chars of SHA-256(salt + text); null stays null."""
    s = salt() if salt_value is None else salt_value
    digest = F.sha2(F.concat(F.lit(s), c.cast("string")), 256)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.substring(digest, 1, PSEUDONYM_HEX_CHARS))


def mask_email(c: Column) -> Column:
    """Split at the first ``@``; keep 2 chars of the local part, then max(len-2, 1) stars,
    domain unchanged. No ``@`` or null: unchanged. ``a@b`` -> ``a*@b``, ``@x`` -> ``*@x``."""
    at = F.instr(c, "@")
    local_len = at - 1
    masked = F.concat(
        F.substring(c, 1, F.least(local_len, F.lit(2))),
        F.repeat(F.lit("*"), F.greatest(local_len - 2, F.lit(1))),
        F.substring(c, at, F.length(c)),
    )
    return F.when(at > 0, masked).otherwise(c)


def apply_pii(df: DataFrame, c: Contract, salt_value: str | None = None) -> DataFrame:
    """Each personal-data column by the policy its contract declares: ``mask_email`` and
    ``pseudonym`` in place; ``pseudonym_column`` drops the column and appends ``<column>_pseudo``.
    Absent columns are skipped."""
    here = {col: policy for col, policy in c.pii.items() if col in df.columns}
    in_place = {"mask_email": lambda col: mask_email(F.col(col)),
                "pseudonym": lambda col: pseudonym(F.col(col), salt_value)}
    moved = [col for col, policy in here.items() if policy == "pseudonym_column"]
    kept = [(in_place[here[n]](n) if n in here else F.col(n)).alias(n) for n in df.columns if n not in moved]
    return df.select(*kept, *[pseudonym(F.col(n), salt_value).alias(f"{n}_pseudo") for n in moved]) if here else df
