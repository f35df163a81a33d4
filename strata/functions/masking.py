"""Masking expressions for personal data (all plain Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.hashing import salted_sha256
from strata.functions.util import as_col

# Mask formats shown to users without clearance.
CPF_MASK_PREFIX = "***.***.***-"
EMAIL_LOCAL_MASK = "***"
FIXED_STARS = "********"
SSN_MASK_PREFIX = "***-**-"


def mask_cpf(c) -> Column:
    """'123.456.789-01' -> '***.***.***-01' (last two characters kept)."""
    v = as_col(c)
    return F.concat(F.lit(CPF_MASK_PREFIX), F.right(v, F.lit(2)))


def mask_email(c) -> Column:
    """Replace the local part: 'ana@x.com' -> '***@x.com'."""
    return F.regexp_replace(as_col(c), r"^[^@]+", EMAIL_LOCAL_MASK)


def keep_last4(c) -> Column:
    """Eight stars then the last four characters."""
    v = as_col(c)
    return F.concat(F.lit(FIXED_STARS), F.substring(v, -4, 4))


def keep_last4_same_length(c) -> Column:
    """Stars for every character but the last four (length kept)."""
    v = as_col(c)
    return F.concat(F.repeat(F.lit("*"), F.greatest(F.length(v) - 4, F.lit(0))), F.substring(v, -4, 4))


def mask_ssn(c) -> Column:
    """'123-45-6789' -> '***-**-6789'."""
    return F.concat(F.lit(SSN_MASK_PREFIX), F.substring(as_col(c), -4, 4))


def ip_subnet(c) -> Column:
    """Drop the host octet of an IPv4 address: '10.1.2.3' -> '10.1.2.0'."""
    return F.regexp_replace(as_col(c), r"\.[0-9]+$", ".0")


def redact(c) -> Column:
    return F.when(as_col(c).isNotNull(), F.lit("REDACTED"))


MASKS = {
    "cpf": mask_cpf,
    "email": mask_email,
    "last4": keep_last4,
    "last4_len": keep_last4_same_length,
    "ssn": mask_ssn,
    "subnet": ip_subnet,
    "redact": redact,
}


def apply_mask(method: str, c, salt: str | None = None) -> Column:
    if method == "hash":
        if not salt:
            raise ValueError("a hash mask needs a salt: an unsalted hash of a short identifier can be looked up")
        return salted_sha256(c, salt)
    if method == "null":
        return F.lit(None).cast("string")
    return MASKS[method](c)
