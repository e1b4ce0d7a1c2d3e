"""Signed tokens and checksums from built-in hash functions, inside code generation."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import fill

# HMAC block size and pads (RFC 2104), and the shortest secret accepted.
BLOCK_BYTES = 64
INNER_PAD = 0x36
OUTER_PAD = 0x5C
MIN_SECRET_BYTES = 32

# Fixed value: the reason reported for changed content.
MISMATCH = "Checksum mismatch: stored={stored} actual={actual}"


def check_secret(secret: str | None) -> bytes:
    """The secret's bytes; blank or too short a secret is refused. The text is never reported."""
    if secret is None or not secret.strip():
        raise ValueError("the token secret must not be blank")
    raw = secret.encode("utf-8")
    if len(raw) < MIN_SECRET_BYTES:
        raise ValueError(f"the token secret must have at least {MIN_SECRET_BYTES} bytes")
    return raw


def pads(secret: str) -> tuple[bytes, bytes]:
    raw = check_secret(secret)
    if len(raw) > BLOCK_BYTES:
        raw = hashlib.sha256(raw).digest()
    block = raw.ljust(BLOCK_BYTES, b"\0")
    return bytes(b ^ INNER_PAD for b in block), bytes(b ^ OUTER_PAD for b in block)


def hmac_sha256(message: Column, secret: str) -> Column:
    """HMAC-SHA256 of UTF-8 text, as binary."""
    inner, outer = pads(secret)
    digest = F.unhex(F.sha2(F.concat(F.lit(inner), message.cast("binary")), 256))
    return F.unhex(F.sha2(F.concat(F.lit(outer), digest), 256))


def base64_url(binary: Column) -> Column:
    """URL-safe Base64 without padding."""
    return F.translate(F.base64(binary), "+/=", "-_")


def sign_token(ticket_id: Column, code: Column, secret: str) -> Column:
    """``id|code.signature``"""
    message = F.concat(ticket_id.cast("string"), F.lit("|"), code)
    return F.concat(message, F.lit("."), base64_url(hmac_sha256(message, secret)))


def verify_token(token: Column, secret: str) -> Column:
    """True if the signature after the last dot fits the text before it."""
    signature = F.substring_index(token, ".", -1)
    message = F.substring(token, F.lit(1), F.length(token) - F.length(signature) - 1)
    fits = base64_url(hmac_sha256(message, secret)) == signature
    return F.coalesce(token.contains(".") & fits, F.lit(False))


def checksum(content: Column) -> Column:
    """SHA-256 as lower-case hex."""
    return F.sha2(content, 256)


def verify_checksum(stored: Column, content: Column) -> Column:
    """NULL when stored and actual checksum agree, otherwise the reason."""
    actual = checksum(content)
    values = {
        "stored": F.coalesce(stored, F.lit("null")),
        "actual": F.coalesce(actual, F.lit("null")),
    }
    return F.when(~stored.eqNullSafe(actual), fill(MISMATCH, values))
