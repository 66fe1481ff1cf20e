"""Document collections as tables: insert, update, delete, lookup, search.

Changes produce a new version of the table as a DataFrame; the caller writes it
where it belongs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import iso_utc


def insert(collection: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    stamp = now if now is not None else F.current_timestamp()
    return collection.unionByName(
        new.withColumns({"created_at": stamp, "updated_at": stamp}), allowMissingColumns=True)


def update(collection: DataFrame, changes: DataFrame, now: Column | None = None) -> DataFrame:
    """Set the non-null fields of ``changes`` on the documents of the same id.

    Of several changes of one id the last one wins: by ``changed_at`` where the
    changes have it (which is not a field then), else the largest by all fields.
    """
    stamp = now if now is not None else F.current_timestamp()
    fields = [c for c in changes.columns if c not in ("id", "changed_at")]
    order = [F.desc(c) for c in ("changed_at", *fields) if c in changes.columns]
    newest = Window.partitionBy("id").orderBy(*order or ["id"])
    last = changes.withColumn("_age", F.row_number().over(newest)).filter("_age = 1")
    renamed = last.select("id", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in fields])
    joined = collection.join(renamed, "id", "left")
    values = {c: F.coalesce(f"_new_{c}", c) for c in fields}
    values["updated_at"] = F.when(F.col("_hit"), stamp).otherwise(F.col("updated_at"))
    return joined.withColumns(values).select(*collection.columns)


def delete(collection: DataFrame, ids: DataFrame) -> DataFrame:
    return collection.join(ids.select("id"), "id", "left_anti")


def matched(collection: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents an update or delete would touch."""
    return collection.join(ids.select("id"), "id", "left_semi")


def find(collection: DataFrame, doc_id: str) -> DataFrame:
    return collection.filter(F.col("id") == doc_id)


def newest(collection: DataFrame, limit: int = 50) -> DataFrame:
    return collection.orderBy(F.desc("created_at"), "id").limit(limit)


def new_and_conflicting(candidates: DataFrame, existing: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Candidates whose key is free, and those whose key is taken."""
    taken = existing.select(key)
    return candidates.join(taken, key, "left_anti"), candidates.join(taken, key, "left_semi")


def active(users: DataFrame) -> DataFrame:
    """Everyone not switched off; an unset flag counts as active."""
    return users.filter(F.coalesce("active", F.lit(True)))


def public(users: DataFrame) -> DataFrame:
    return users.drop("password_hash")


def without_display(results: DataFrame) -> DataFrame:
    return results.drop("summary", "notes", "charts")


def set_fields(update_map: Column) -> Column:
    """Entries of an update document that carry a value."""
    return F.map_filter(update_map, lambda _, v: v.isNotNull())


def search(listing: DataFrame, text: str, limit: int = 15) -> DataFrame:
    """Case-insensitive substring search over ticker and name."""
    wanted = text.strip().lower()
    hit = F.lower("ticker").contains(wanted) | F.lower("name").contains(wanted)
    return listing.filter(hit).orderBy("ticker").limit(limit)


def analyses_of_crawls(crawls: DataFrame, analyses: DataFrame) -> DataFrame:
    """Crawl and analysis documents that share a ticker, whether the analysis
    names one ticker or a list.  The list is exploded first, so this is a plain
    equi-join that adaptive execution can split on hot tickers."""
    names = F.array_distinct(F.array_compact(F.concat(F.array("ticker"), F.coalesce("tickers", F.array().cast("array<string>")))))
    keyed = analyses.select(F.col("id").alias("analysis_id"), F.explode(names).alias("ticker"))
    return crawls.select(F.col("id").alias("crawl_id"), "ticker").join(keyed, "ticker")


def serialize(docs: DataFrame) -> DataFrame:
    """``_id`` becomes ``id``, timestamps become ISO text, the rest one JSON body."""
    times = [f.name for f in docs.schema.fields if f.dataType.typeName() in ("timestamp", "timestamp_ntz")]
    out = docs.withColumns({c: iso_utc(F.col(c)) for c in times}).withColumnRenamed("_id", "id")
    return out.select("id", F.to_json(F.struct(*out.columns)).alias("body"))
