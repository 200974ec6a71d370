"""Content-addressed identities, hash partitions and splits, as column expressions."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUL = "decode(unhex('00'), 'utf-8')"


def hex_number(digest: Column, digits: int) -> Column:
    """The leading hex digits of a digest as an exact number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("decimal(20,0)")


def hash_partition(dataset: Column, path: Column, parts: int) -> Column:
    """Owner of a path: the first 16 hex digits of sha256(dataset NUL path), modulo parts."""
    digest = F.sha2(F.concat(dataset, F.expr(NUL), path), 256)
    return F.pmod(hex_number(digest, 16), F.lit(parts).cast("decimal(20,0)")).cast("int")


def digest_partition(digest: Column, parts: int) -> Column:
    """Owner of a record whose id is a digest already."""
    return F.pmod(hex_number(digest, 16), F.lit(parts).cast("decimal(20,0)")).cast("int")


def hash_split(key: Column) -> Column:
    """train, validation or test, 80 / 10 / 10 by sha256."""
    bucket = F.pmod(hex_number(F.sha2(key, 256), 8), F.lit(1000).cast("decimal(20,0)"))
    return F.when(bucket < 800, "train").when(bucket < 900, "validation").otherwise("test")


def object_id(bucket: Column, key: Column) -> Column:
    """sha256(bucket NUL key); empty names are refused."""
    bad = bucket.isNull() | (bucket == "") | key.isNull() | (key == "")
    return F.when(bad, F.raise_error(F.lit("bucket and key must not be empty"))).otherwise(F.sha2(F.concat(bucket, F.expr(NUL), key), 256))


def json_text(value: Column) -> Column:
    """A string as a JSON literal with ASCII escapes, as Python writes it."""
    return _dumps(value)


@F.pandas_udf(T.StringType())
def _dumps(value: pd.Series) -> pd.Series:
    return value.map(json.dumps)


def stable_id(kind: str, *parts: Column) -> Column:
    """kind_ and the first 24 hex digits of sha256 over the compact JSON list of string parts."""
    listed = F.concat(F.lit("["), F.concat_ws(",", *[json_text(p) for p in parts]), F.lit("]"))
    return F.concat(F.lit(kind + "_"), F.substring(F.sha2(listed, 256), 1, 24))


@F.pandas_udf(T.StringType())
def semantic_hash(payload: pd.Series) -> pd.Series:
    """sha256 of a JSON text in canonical form: sorted keys, no spaces, ASCII escapes. Null stays null."""

    def one(raw):
        if raw is None:
            return None
        return hashlib.sha256(json.dumps(json.loads(raw), sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    return payload.map(one)


def pack_id(ordered_ids: Column) -> Column:
    """Identity of a pack: sha256 over its object ids in order."""
    return F.sha2(F.array_join(ordered_ids, "\n"), 256)


def safe_label(label: Column) -> Column:
    """True for names that cannot leave their folder."""
    return label.isNotNull() & ~label.rlike(r"[/\\\\]") & ~label.isin("", ".", "..")


def shard_label(number: Column, width: int = 5) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def bar_ticks(tpq: Column, numerator: Column, denominator: Column) -> Column:
    """Ticks of a bar; an error unless they are whole."""
    total = tpq * 4 * numerator
    return F.when(total % denominator == 0, (total / denominator).cast("bigint")).otherwise(F.raise_error(F.lit("a bar must be a whole number of ticks")).cast("bigint"))
