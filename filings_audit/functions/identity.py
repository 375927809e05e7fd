"""Hashes and stable identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 4122 namespace for URLs.
URL_NAMESPACE_HEX = "6ba7b8119dad11d180b400c04fd430c8"


def salted_sha256(value: Column, salt: str) -> Column:
    """hex SHA-256 of ``salt:value``; null stays null (``concat``, not ``concat_ws``)."""
    return F.sha2(F.concat(F.lit(f"{salt}:"), value), 256)


def uuid5_url(name: Column) -> Column:
    """Version 5 UUID of ``name`` in the URL namespace.

    Built from operations that Spark knows never add a null, so that a not-null test on an id costs nothing.
    """
    digest = F.sha1(F.concat(F.lit(bytes.fromhex(URL_NAMESPACE_HEX)), name.cast("binary")))
    # Variant: keep the digit's two low bits and set the high bits to 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def filing_uuid(cik: Column, filing_date: Column, form_type: Column) -> Column:
    """stable filing id from ``cik:filing_date:form_type``; a missing part reads ``None``."""
    parts = [F.coalesce(part.cast("string"), F.lit("None")) for part in (cik, filing_date, form_type)]
    return uuid5_url(F.concat(parts[0], F.lit(":"), parts[1], F.lit(":"), parts[2]))


def md5_mod(value: Column, modulus: int) -> Column:
    """The md5 of ``value``, read as one 128-bit number, modulo a small ``modulus``.

    Taken 44 bits at a time, so it never leaves the arithmetic of longs, and in as few steps as that allows: the code
    generated for a row must stay small enough to be compiled.
    """
    digest = F.md5(value)
    out = F.lit(0).cast("long")
    for start, digits in ((1, 11), (12, 11), (23, 10)):
        word = F.conv(F.substring(digest, start, digits), 16, 10).cast("long")
        out = (out * (16**digits % modulus) + word) % modulus
    return out.cast("int")
