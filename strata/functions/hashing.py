"""Hash expressions: content hashes that see NULLs, salted pseudonyms, stable salts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.util import as_col

# Marks a NULL inside a concatenation so ("a", NULL, "b") and ("a", "b", NULL) differ.
NULL_MARK = "\u0000"
SEP = "|"


def null_safe_concat(*columns, sep: str = SEP) -> Column:
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.concat_ws(sep, *parts)


def content_hash(*columns, algo: str = "md5") -> Column:
    """Row fingerprint over the given columns; NULL positions count."""
    s = null_safe_concat(*columns)
    return F.md5(s) if algo == "md5" else F.sha2(s, 256)


def salted_sha256(c, salt: str) -> Column:
    """Pseudonym: sha256 of value || salt (NULL stays NULL)."""
    v = as_col(c).cast("string")
    return F.when(v.isNotNull(), F.sha2(F.concat(v, F.lit(salt)), 256))


def stable_salt(row_id, n: int) -> Column:
    """Salt in [0, n) from a deterministic hash of a row id: retries give the same salt."""
    return F.pmod(F.xxhash64(as_col(row_id)), F.lit(n)).cast("int")


def key_bucket(keys, n: int) -> Column:
    """Bucket number of a key tuple in [0, n)."""
    return F.pmod(F.xxhash64(*[as_col(k) for k in keys]), F.lit(n)).cast("int")
