"""Encryption of columns on write and decryption on read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.columns import require_columns


def _key(key: str | Column) -> Column:
    return F.lit(key) if isinstance(key, str) else key


def encrypt_columns(df: DataFrame, columns: list[str], key: str | Column) -> DataFrame:
    """Replace columns by base64 text of their AES-GCM ciphertext.

    The key (16, 24 or 32 bytes) comes from the caller and is never stored. A
    text key is a literal and so visible in the plan; pass a `Column` read from
    a protected table where plans are logged.
    """
    require_columns(df, columns)
    return df.withColumns(
        {c: F.base64(F.aes_encrypt(F.col(f"`{c}`").cast("string"), _key(key))) for c in columns}
    )


def decrypt_columns(df: DataFrame, columns: list[str], key: str | Column) -> DataFrame:
    """Inverse of `encrypt_columns`; the columns come back as text."""
    require_columns(df, columns)
    return df.withColumns(
        {c: F.aes_decrypt(F.unbase64(F.col(f"`{c}`")), _key(key)).cast("string") for c in columns}
    )
