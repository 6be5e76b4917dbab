"""AES-CBC column encryption.

Key and initial vector always come from the caller. They become literals of the
plan: set ``spark.sql.redaction.string.regex`` where plans are logged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablecheck.functions.predicates import as_text

IV_BYTES = 16


def _literal(value: bytes, sizes: tuple[int, ...], what: str) -> Column:
    if len(value) not in sizes:
        raise ValueError(f"{what} must have {' or '.join(map(str, sizes))} bytes")
    return F.lit(bytearray(value))


def encrypt_text(c: Column | str, key: bytes, iv: bytes | None = None) -> Column:
    """AES-CBC with PKCS padding, as Base64.

    With ``iv`` the result holds the cipher text only. Without it every value
    gets a random vector, kept in front of the cipher text.
    """
    secret = _literal(key, (16, 24, 32), "key")
    plain = as_text(c).cast("binary")
    cbc, pkcs = F.lit("CBC"), F.lit("PKCS")
    if iv is None:
        return F.base64(F.aes_encrypt(plain, secret, cbc, pkcs))
    sealed = F.aes_encrypt(plain, secret, cbc, pkcs, _literal(iv, (IV_BYTES,), "iv"))
    return F.base64(F.substr(sealed, F.lit(IV_BYTES + 1)))


def decrypt_text(c: Column | str, key: bytes, iv: bytes | None = None) -> Column:
    """Reverse of ``encrypt_text``; text that cannot be decrypted gives NULL."""
    secret = _literal(key, (16, 24, 32), "key")
    sealed = F.call_function("try_to_binary", as_text(c), F.lit("base64"))
    if iv is not None:
        sealed = F.concat(_literal(iv, (IV_BYTES,), "iv"), sealed)
    plain = F.try_aes_decrypt(sealed, secret, F.lit("CBC"), F.lit("PKCS"))
    return plain.cast("string")
