"""Encryption, decryption and blind indexes as column expressions.

Keys reach a plan as a column of a one-row frame, not as a literal, so they are in
no explained plan. Encryption draws a new nonce for each value: write the result
before anything filters, guards or reads it twice.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Envelope of a ciphertext: enc:<key version>:<base64 of nonce, ciphertext and tag>.
ENVELOPE = r"^enc:[^:]+:[A-Za-z0-9+/]+=*$"
_KEY_COLUMN = "__protection_key"


@dataclass(frozen=True)
class Keys:
    version: str
    data: bytes
    index: bytes

    @classmethod
    def from_environment(cls) -> Keys:
        names = ("VEILFRAME_KEY_VERSION", "VEILFRAME_DATA_KEY", "VEILFRAME_INDEX_KEY")
        version, data, index = (os.environ[n] for n in names)
        return cls(version, bytes.fromhex(data), bytes.fromhex(index))


def _padded(key: bytes, pad: int) -> bytearray:
    return bytearray(b ^ pad for b in key.ljust(64, b"\0"))


def _key_row(spark: SparkSession, keys: Keys, data: bool) -> DataFrame:
    """One row; the inner and outer pads of the index key are all that its holder needs."""
    index = keys.index if len(keys.index) <= 64 else __import__("hashlib").sha256(keys.index).digest()
    row = (bytearray(keys.data) if data else None, _padded(index, 0x36), _padded(index, 0x5C))
    return spark.createDataFrame([(row,)], f"{_KEY_COLUMN} struct<data:binary,inner:binary,outer:binary>")


def _missing(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text != "", text)


def _aad(version: str, field: str) -> Column:
    return F.lit(f"{version}|{field}")


def _hmac(message: Column) -> Column:
    key = F.col(_KEY_COLUMN)
    inner = F.unhex(F.sha2(F.concat(key["inner"], F.encode(message, "UTF-8")), 256))
    return F.unhex(F.sha2(F.concat(key["outer"], inner), 256))


def _blind_index(field: str, value: Column) -> Column:
    """First 16 bytes of the HMAC of field and value, in URL-safe base64 without padding: equal for equal values of one field."""
    mac = F.substring(_hmac(F.concat(F.lit(f"{field}|"), _missing(value))), 1, 16)
    return F.rtrim(F.translate(F.base64(mac), "+/=", "-_ "))


class Encryptor:
    """Can encrypt and index, and holds no way to decrypt."""

    def __init__(self, keys: Keys):
        self._keys = keys

    def protect(self, df: DataFrame, encrypt: dict[str, str], index: dict[str, str], drop: bool = True) -> DataFrame:
        """``encrypt`` and ``index`` name new columns by source column; the field bound in is the source column's name."""
        with_key = df.crossJoin(F.broadcast(_key_row(df.sparkSession, self._keys, data=True)))
        key = F.col(_KEY_COLUMN)["data"]
        new = {}
        for source, target in encrypt.items():
            sealed = F.aes_encrypt(_missing(F.col(source)), key, F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), _aad(self._keys.version, source))
            new[target] = F.concat(F.lit(f"enc:{self._keys.version}:"), F.base64(sealed))
        for source, target in index.items():
            new[target] = _blind_index(source, F.col(source))
        out = with_key.withColumns(new).drop(_KEY_COLUMN)
        return out.drop(*encrypt) if drop else out

    def encrypt_value(self, df: DataFrame, value: Column, field: str, target: str) -> DataFrame:
        with_key = df.crossJoin(F.broadcast(_key_row(df.sparkSession, self._keys, data=True)))
        sealed = F.aes_encrypt(_missing(value), F.col(_KEY_COLUMN)["data"], F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), _aad(self._keys.version, field))
        return with_key.withColumn(target, F.concat(F.lit(f"enc:{self._keys.version}:"), F.base64(sealed))).drop(_KEY_COLUMN)


class Decryptor:
    """Can decrypt, and holds no way to encrypt."""

    def __init__(self, keys: Keys):
        self._keys = keys

    def reveal(self, df: DataFrame, fields: dict[str, str], into) -> DataFrame:
        """Replace each ciphertext column by ``into(source, plaintext)``; a bad prefix, version or tag fails the job.

        ``fields`` maps ciphertext columns to the field names they were encrypted under.
        ``into`` returns {new column: expression}, so plaintext needs no column of its own.
        """
        with_key = df.crossJoin(F.broadcast(_key_row(df.sparkSession, self._keys, data=True)))
        new = {}
        for column, field in fields.items():
            parts = F.split(F.col(column), ":", 3)
            whole = F.coalesce((parts[0] == "enc") & (parts[1] == self._keys.version) & (F.size(parts) == 3), F.lit(False))
            checked = F.when(whole, F.unbase64(parts[2])).otherwise(F.raise_error(F.lit(f"{column}: not an envelope of key version {self._keys.version}")).cast("binary"))
            plain = F.when(F.col(column).isNotNull(), F.aes_decrypt(checked, F.col(_KEY_COLUMN)["data"], F.lit("GCM"), F.lit("DEFAULT"), _aad(self._keys.version, field)).cast("string"))
            new |= into(field, plain)
        return with_key.withColumns(new).drop(_KEY_COLUMN, *fields)
