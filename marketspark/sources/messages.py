"""Keyed JSON messages: encoding, strict decoding, dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def encode(df: DataFrame, key: str, *keep: str) -> DataFrame:
    """Rows as (key, value) messages; ``keep`` columns stay outside the value."""
    body = [c for c in df.columns if c not in keep]
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*body)).alias("value"), *keep)


def decode(messages: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """Permissive decoding: unreadable parts become null."""
    return messages.select(*keep, F.from_json(F.col("value").cast("string"), schema).alias("data")).select(*keep, "data.*")


def judged(
    messages: DataFrame, schema: T.StructType, optional: tuple[str, ...] = ("timestamp",), key: str | None = None, time: str | None = None
) -> DataFrame:
    """``messages`` with ``data``, the decoded record, and ``error``, what is wrong with it: null when nothing is.

    As strict as a fixed record type: every field but the optional ones must be
    there, no other may be, and a value must be of its field's type.  ``key`` names a field that may not be null,
    ``time`` one that must be a time.  A row is either good or bad, so filters on ``error`` split the messages without loss
    and without repeats.  A message is read once, as the one row of an explode: filters on ``error`` do not pass below it, and
    its fields are not taken from readings of their own, one a field.
    """
    names = [f.name for f in schema.fields]
    text = F.col("value").cast("string")
    known = F.array(*[F.lit(n) for n in names])
    required = F.array(*[F.lit(n) for n in names if n not in optional])
    plain = T.StructType([T.StructField(n, T.StringType()) for n in names])
    read = F.struct(F.from_json(text, schema).alias("data"), F.from_json(text, plain).alias("texts"), F.json_object_keys(text).alias("keys"))
    rows = messages.select("*", F.explode(F.array(read)).alias("__read"))
    data, texts, keys = (F.col("__read")[c] for c in ("data", "texts", "keys"))
    wrong = F.lit(False)
    for n in names:
        wrong = wrong | (texts[n].isNotNull() & data[n].isNull())
    late = []
    if key:
        late.append(F.when(data[key].isNull(), "no key"))
    if time:
        late.append(F.when(F.try_to_timestamp(data[time]).isNull(), "no time"))
    by_keys = (
        F.when(keys.isNull(), "malformed")
        .when(F.size(F.array_except(required, keys)) > 0, "missing field")
        .when(F.size(F.array_except(keys, known)) > 0, "unknown field")
    )
    return rows.withColumns({"data": data, "error": F.coalesce(by_keys, F.when(wrong, "wrong type"), *late)}).drop("__read")


def split_good_bad(
    messages: DataFrame, schema: T.StructType, optional: tuple[str, ...] = ("timestamp",)
) -> tuple[DataFrame, DataFrame]:
    """Decoded rows with provenance, and the dead letters."""
    rows = judged(messages, schema, optional)
    good = rows.filter("error is null").select(
        *[F.col("data")[f.name].alias(f.name) for f in schema.fields], F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"), F.current_timestamp().alias("_consumed_at"),
    )
    bad = rows.filter("error is not null").select("key", "value", "partition", "offset", "error")
    return good, bad
