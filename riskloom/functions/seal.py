"""Reversible encryption of label strings with the built-in AES functions.

``seal``/``unseal`` are the default: authenticated, with a random IV per value.
``seal_cbc``/``unseal_cbc`` produce and read the older delivery format (zero
padding, IV equal to the key) for partners who still need it. Keys come from
configuration; none is stored here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 16


def _padded_key(key: str) -> Column:
    raw = key.encode("utf-8")
    raw += b"\0" * (-len(raw) % BLOCK)
    if len(raw) not in (16, 24, 32):
        raise ValueError("key must have 1 to 32 bytes")
    return F.lit(bytearray(raw))


def seal(text: Column, key: str) -> Column:
    return F.lower(F.hex(F.aes_encrypt(F.encode(text, "UTF-8"), _padded_key(key), F.lit("GCM"), F.lit("DEFAULT"))))


def unseal(sealed: Column, key: str) -> Column:
    plain = F.aes_decrypt(F.unhex(sealed), _padded_key(key), F.lit("GCM"), F.lit("DEFAULT"))
    return F.decode(plain, "UTF-8")


def seal_cbc(text: Column, key: str) -> Column:
    """Lower-case hex of AES-CBC over zero-padded bytes; empty text gives empty hex."""
    raw = F.encode(text, "UTF-8")
    size = (F.ceil(F.octet_length(raw) / BLOCK) * BLOCK).cast("int")
    padded = F.unhex(F.rpad(F.hex(raw), size * 2, F.lit("0")))
    secret = _padded_key(key)
    # The first key block is the IV. The function prefixes the IV and adds a padding block; both are cut.
    boxed = F.aes_encrypt(padded, secret, F.lit("CBC"), F.lit("PKCS"), F.substring(secret, 1, BLOCK))
    return F.lower(F.hex(F.substring(boxed, F.lit(BLOCK + 1), size)))


def unseal_cbc(sealed: Column, key: str) -> Column:
    """Text of :func:`seal_cbc` output, trailing zero bytes removed."""
    secret = _padded_key(key)
    iv = F.substring(secret, 1, BLOCK)
    body = F.unhex(sealed)
    last = F.when(F.octet_length(body) >= BLOCK, F.substring(body, F.octet_length(body) - BLOCK + 1, F.lit(BLOCK)))
    closing = F.substring(
        F.aes_encrypt(F.lit(bytearray()), secret, F.lit("CBC"), F.lit("PKCS"), F.coalesce(last, iv)),
        BLOCK + 1,
        BLOCK,
    )
    plain = F.aes_decrypt(F.concat(iv, body, closing), secret, F.lit("CBC"), F.lit("PKCS"))
    return F.rtrim(F.decode(plain, "UTF-8"), F.lit("\0"))
