"""Protection stages: encrypted artifact, card table, masked artifact, and the guards that refuse to write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions import cards, crypto
from veilframe.functions.ids import row_hash
from veilframe.functions.masks import apply_mask
from veilframe.operators.classify import Manifest
from veilframe.operators.policies import MissingPolicy, uncovered

CIPHER, INDEX, MASKED = "_encrypted", "_blind_index", "_masked"
#: Shorter values may turn up in ciphertext bytes by chance.
LEAST_LEAK = 6


class LeakError(RuntimeError):
    """Plaintext would be written."""


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, '' as null: the form of stored artifacts."""
    return df.select(*(F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns))


def key_column(manifest: Manifest, logical_date: str) -> tuple[str, Column]:
    """Name and value of the key of an artifact: a row hash, a blind index, or the plain key."""
    key = manifest.primary_key
    if manifest.key_is_synthetic:
        return key, row_hash(manifest.names(), logical_date)
    if key in manifest.names(sensitive=True):
        return f"{key}{INDEX}", F.col(f"{key}{INDEX}")
    return key, F.col(key)


def encrypt_batch(df: DataFrame, manifest: Manifest, encryptor: crypto.Encryptor, logical_date: str) -> DataFrame:
    """Key, logical_date, public columns, ciphertexts, blind indexes. Write this before reading it again: every reading draws new nonces."""
    rows = as_text(df)
    secret, public = sorted(manifest.names(sensitive=True)), manifest.names(sensitive=False)
    if manifest.key_is_synthetic:
        rows = rows.withColumn(manifest.primary_key, row_hash(manifest.names(), logical_date))
    sealed = encryptor.protect(rows, {c: c + CIPHER for c in secret}, {c: c + INDEX for c in manifest.indexed}, drop=True)
    key, _ = key_column(manifest, logical_date)
    rest = [c for c in public if c != key]
    indexes = [c + INDEX for c in sorted(manifest.indexed) if c + INDEX != key]
    return sealed.select(key, F.lit(logical_date).alias("logical_date"), *rest, *(c + CIPHER for c in secret), *indexes)


def card_table(df: DataFrame, manifest: Manifest, encryptor: crypto.Encryptor, logical_date: str) -> DataFrame:
    """A row per row and card column: source_column, row_key, card_prefix, card_middle_encrypted, card_suffix.

    row_key is never a sensitive value: a sensitive key is indexed. A number too short
    to split is encrypted whole, and its clear parts are empty.
    """
    rows = as_text(df)
    key = manifest.primary_key
    if manifest.key_is_synthetic:
        rows = rows.withColumn(key, row_hash(manifest.names(), logical_date))
    elif key in manifest.names(sensitive=True):
        rows = encryptor.protect(rows, {}, {key: key + INDEX}, drop=False)
        key += INDEX
    out = None
    for c in manifest.cards:
        parts = cards.split(F.col(c))
        one = rows.select(F.lit(c).alias("source_column"), F.col(key).alias("row_key"), parts.alias("p")).withColumn("short", F.col("p.middle") == "")
        secret = F.when(F.col("short"), F.col("p.prefix")).otherwise(F.col("p.middle"))
        one = encryptor.encrypt_value(one, secret, f"{c}_middle", "card_middle_encrypted").select(
            "source_column", "row_key", F.when(F.col("short"), "").otherwise(F.col("p.prefix")).alias("card_prefix"), "card_middle_encrypted", F.col("p.suffix").alias("card_suffix"),
        )
        out = one if out is None else out.unionByName(one)
    if out is None:
        return df.sparkSession.createDataFrame([], "source_column string, row_key string, card_prefix string, card_middle_encrypted string, card_suffix string")
    return out


def mask_batch(encrypted: DataFrame, manifest: Manifest, decryptor: crypto.Decryptor, masks: dict[str, str], masked_by: str) -> DataFrame:
    """Key, logical_date, masked_by, public columns, blind indexes, masked columns.

    Plaintext lives only inside one expression per column, with the check that the
    mask changed it. Columns without a mask make this refuse.
    """
    secret = sorted(manifest.names(sensitive=True))
    if bare := uncovered(secret, masks):
        raise MissingPolicy(f"no mask for {', '.join(bare)}")

    def into(field: str, plain: Column) -> dict[str, Column]:
        masked = apply_mask(masks[field], plain)
        same = plain.isNotNull() & (plain != "") & masked.eqNullSafe(plain)
        refusal = F.raise_error(F.lit(f"{field}: mask {masks[field]} leaves a value as it was")).cast("string")
        return {field + MASKED: masked if masks[field] in ("NONE", "MASK_NONE") else F.when(same, refusal).otherwise(masked)}

    opened = decryptor.reveal(encrypted, {c + CIPHER: c for c in secret}, into)
    plain = [c for c in opened.columns if not c.endswith((MASKED, INDEX)) and c != "logical_date"]
    indexes = [c for c in opened.columns if c.endswith(INDEX)]
    key = manifest.primary_key + INDEX if manifest.primary_key in secret else manifest.primary_key
    layout = [key, "logical_date", F.lit(masked_by).alias("masked_by"), *(c for c in plain if c != key), *(c for c in indexes if c != key), *(c + MASKED for c in secret)]
    return opened.select(*layout)


def encryption_leaks(artifact: DataFrame, source: DataFrame, key: str, sensitive: list[str]) -> DataFrame:
    """column, kind, n of every way the written artifact shows plaintext; empty if it is safe.

    ``source`` has the key and the plaintext; both sides are joined on the key.
    """
    kinds = []
    both = artifact.join(source.select(F.col(key).alias("__k"), *(F.col(c).alias(f"__p_{c}") for c in sensitive if c in source.columns)), F.col(key) == F.col("__k"))
    for c in sensitive:
        if c in artifact.columns:
            kinds.append((c, "plaintext column", F.lit(True)))
        if c + CIPHER not in artifact.columns:
            continue
        sealed, plain = F.col(c + CIPHER), F.col(f"__p_{c}")
        body = F.try_to_binary(F.substring_index(sealed, ":", -1), F.lit("base64"))  # null for what is no envelope
        kinds += [
            (c, "not an envelope", sealed.isNotNull() & ~sealed.rlike(crypto.ENVELOPE)),
            (c, "equals plaintext", sealed == plain),
            (c, "contains plaintext", (F.length(plain) >= LEAST_LEAK) & (F.instr(F.hex(body), F.hex(F.encode(plain, "UTF-8"))) > 0)),
        ]
    if not kinds:
        return artifact.sparkSession.createDataFrame([], "column string, kind string, n long")
    counts = both.agg(*(F.sum(F.coalesce(found, F.lit(False)).cast("long")).alias(f"n{i}") for i, (_, _, found) in enumerate(kinds)))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col(f"n{i}").alias("n")) for i, (c, kind, _) in enumerate(kinds)))
    return counts.select(F.explode(rows).alias("r")).select("r.*").where("n > 0")


def card_leaks(table: DataFrame) -> DataFrame:
    """Rows of a card table whose clear parts hold a whole card number."""
    return table.where(cards.is_card_number(F.col("card_prefix")) | cards.is_card_number(F.col("card_suffix")) | cards.is_card_number(F.concat("card_prefix", "card_suffix")))


def flat_leaks(columns: list[str], sensitive: list[str]) -> list[str]:
    """Columns that must not be in a public message: sensitive ones and whatever is derived from them."""
    return sorted(c for c in columns if c in sensitive or c.endswith((CIPHER, INDEX, MASKED)))


def refuse_if_any(leaks: DataFrame, what: str) -> None:
    found = leaks.limit(5).collect()
    if found:
        raise LeakError(f"{what}: " + "; ".join(", ".join(f"{k}={v}" for k, v in r.asDict().items() if k in ("column", "kind", "n", "source_column", "row_key")) for r in found))
