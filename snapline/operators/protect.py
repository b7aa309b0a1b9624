"""Column protection: AES-256-GCM, hashing, dropping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value. Layout of a cell: 12 bytes IV, ciphertext, 16 bytes tag.
MODE = "GCM"


def key_from_file(spark: SparkSession, path: str) -> Column:
    """The 32 key bytes as a scalar subquery: plans and logs show the path, not the key."""
    return spark.read.format("binaryFile").load(path).select("content").scalar()


def encrypt_columns(df: DataFrame, columns: Sequence[str], key: Column) -> DataFrame:
    """Each column as text, encrypted with a random IV per cell; NULL stays NULL."""
    return df.withColumns({
        name: F.aes_encrypt(F.col(name).cast("string"), key, F.lit(MODE)) for name in columns
    })


def decrypt_columns(df: DataFrame, columns: Sequence[str], key: Column, strict: bool = True) -> DataFrame:
    """Back to text. A wrong key or a damaged cell raises; with ``strict=False`` it is NULL."""
    decrypt = F.aes_decrypt if strict else F.try_aes_decrypt
    return df.withColumns({name: decrypt(F.col(name), key, F.lit(MODE)).cast("string") for name in columns})


def mask(df: DataFrame, policy: Mapping[str, str], key: Column | None = None) -> DataFrame:
    """Per column ``drop``, ``hash`` (SHA-256 hex) or ``encrypt``; other columns stay."""
    wrong = {how for how in policy.values()} - {"drop", "hash", "encrypt"}
    if wrong:
        raise ValueError(f"unknown protection: {sorted(wrong)}")
    hidden = [name for name, how in policy.items() if how == "encrypt"]
    if hidden and key is None:
        raise ValueError("encrypt needs a key")
    hashed = {n: F.sha2(F.col(n).cast("string"), 256) for n, how in policy.items() if how == "hash"}
    if hashed:
        df = df.withColumns(hashed)
    if hidden:
        df = encrypt_columns(df, hidden, key)
    return df.drop(*[name for name, how in policy.items() if how == "drop"])
