"""Encryption and tokens as Column functions: AES-256-GCM with the user's id as associated data, HMAC-SHA256, and the stored forms.

Keys come as columns of 64 hex digits, never as literals. Ciphertext is new on every evaluation, so write it before anything is derived from it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IV_BYTES = 12
#: Fixed values of HMAC: the bytes that pad and mask the key.
INNER, OUTER = 0x36, 0x5C


def base64_line(value: Column) -> Column:
    """Base64 without the line breaks that Spark adds to long values."""
    return F.translate(F.base64(value), "\r\n", "")


def encrypt_raw(value: Column, dek_hex: Column, user_id: Column) -> Column:
    """Random initial vector, ciphertext and tag of a text, as bytes."""
    return F.aes_encrypt(F.encode(value, "UTF-8"), F.unhex(dek_hex), F.lit("GCM"), F.lit("DEFAULT"), F.lit("").cast("binary"), F.encode(user_id, "UTF-8"))


def encrypt(value: Column, dek_hex: Column, user_id: Column) -> Column:
    """The payload form: base64 of ``encrypt_raw``."""
    return base64_line(encrypt_raw(value, dek_hex, user_id))


def decrypt_raw(raw: Column, dek_hex: Column, user_id: Column) -> Column:
    """The text, or null if key, user or bytes don't fit."""
    return F.decode(F.try_aes_decrypt(raw, F.unhex(dek_hex), F.lit("GCM"), F.lit("DEFAULT"), F.encode(user_id, "UTF-8")), "UTF-8")


def decrypt(payload: Column, dek_hex: Column, user_id: Column) -> Column:
    """The text of a payload."""
    return decrypt_raw(F.unbase64(payload), dek_hex, user_id)


def _masked(dek_hex: Column, mask: int) -> Column:
    word = int.from_bytes(bytes([mask]) * 4, "big")
    pieces = [F.lpad(F.hex(F.conv(F.substring(dek_hex, 1 + 8 * i, 8), 16, 10).cast("long").bitwiseXOR(F.lit(word))), 8, "0") for i in range(8)]
    return F.unhex(F.concat(*pieces, F.lit(f"{mask:02x}" * 32)))


def masks(dek_hex: Column) -> dict[str, Column]:
    """The columns ``inner_mask`` and ``outer_mask`` of a user's key, from which ``masked_token`` makes tokens."""
    return {"inner_mask": _masked(dek_hex, INNER), "outer_mask": _masked(dek_hex, OUTER)}


def masked_token(value: Column) -> Column:
    """The token of a text of a row that has the columns of ``masks``."""
    return _hmac(value, F.col("inner_mask"), F.col("outer_mask"))


def token(value: Column, dek_hex: Column) -> Column:
    """HMAC-SHA256 of a text under the user's key, 64 hex digits: equal within a user only."""
    return _hmac(value, _masked(dek_hex, INNER), _masked(dek_hex, OUTER))


def _hmac(value: Column, inner: Column, outer: Column) -> Column:
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(value, "UTF-8")), 256))), 256)


def bundle(value: Column, dek_hex: Column, user_id: Column, key_id: Column) -> Column:
    """``key_id:iv:ciphertext`` with base64 parts. The ciphertext is bound once, so both parts are of the same one."""
    parts = lambda raw: F.concat_ws(":", key_id, base64_line(F.substring(raw, 1, IV_BYTES)), base64_line(F.substring(raw, IV_BYTES + 1, 1 << 30)))
    return F.when(value.isNotNull(), F.element_at(F.transform(F.array(encrypt_raw(value, dek_hex, user_id)), parts), 1))


def vault_value(text: Column) -> Column:
    """Base64 of a bundle, the form in which the vault keeps it."""
    return base64_line(F.encode(text, "UTF-8"))


def open_bundle(text: Column, dek_hex: Column, user_id: Column) -> Column:
    """The text in a bundle, or in a bare payload (two forms share one column); null if it can't be opened."""
    parts = F.split(text, ":")
    raw = F.concat(F.unbase64(F.element_at(parts, -2)), F.unbase64(F.element_at(parts, -1)))
    return F.when(F.size(parts) >= 3, decrypt_raw(raw, dek_hex, user_id)).otherwise(decrypt(F.when(F.size(parts) == 1, text), dek_hex, user_id))


def open_vault_value(stored: Column, dek_hex: Column, user_id: Column) -> Column:
    """The text of a stored vault value."""
    return open_bundle(F.decode(F.unbase64(stored), "UTF-8"), dek_hex, user_id)


def unwrap(wrapped: Column, wrapping_key_hex: Column) -> Column:
    """Hex key in a base64 envelope that was closed with another key; null if that key doesn't fit."""
    return F.lower(F.hex(F.try_aes_decrypt(F.unbase64(wrapped), F.unhex(wrapping_key_hex), F.lit("GCM"), F.lit("DEFAULT"))))
