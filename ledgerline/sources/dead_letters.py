"""Dead letters: payloads of rejected changes, their parsing, and what is still open of them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import judged

#: Fields of a dead letter's payload that come back as columns, with their values if absent.
FIELDS = {"transaction_id": "", "merchant_id": "", "amount_minor": 0, "currency": "", "status": "", "event_type": "", "op": "c", "lsn": 0, "rejection_reason": "", "rejected_at": ""}


def payload(rejected: DataFrame, rejected_at: str) -> DataFrame:
    """key and value of each rejected change; null fields are absent from the value, and a null id gets a random key."""
    told = rejected.withColumn("rejected_at", F.lit(rejected_at))
    return told.select(F.coalesce("transaction_id", F.uuid()).alias("key"), F.to_json(F.struct("*")).alias("value"))


def parse(messages: DataFrame) -> DataFrame:
    """offset, key, value to FIELDS: what isn't a JSON object counts as empty, an absent id is the key, falsy values are the defaults."""
    body = F.from_json("value", "map<string, string>")
    get = lambda c: F.try_element_at(body, F.lit(c))
    columns = []
    for name, default in FIELDS.items():
        if name == "transaction_id":
            columns.append(F.coalesce(F.nullif(get(name), F.lit("")), F.col("key"), F.lit("")).alias(name))
        elif isinstance(default, int):
            columns.append(F.coalesce(get(name).try_cast("bigint"), F.lit(0)).alias(name))
        else:
            columns.append(F.coalesce(F.nullif(get(name), F.lit("")), F.lit(default)).alias(name))
    return messages.select("offset", *columns, F.col("value").alias("payload"))


def keys(letters: DataFrame) -> DataFrame:
    """Distinct ids; a letter without an id has none."""
    return letters.select("transaction_id").filter("transaction_id is not null").distinct()


def open_letters(letters: DataFrame, lake: DataFrame) -> DataFrame:
    """Letters whose change the lake doesn't hold yet, that is unless it has the id at the letter's lsn or a higher one."""
    held = lake.select(F.col("transaction_id").alias("_id"), F.col("lsn").alias("lake_lsn"))
    joined = letters.join(held, F.col("transaction_id") == F.col("_id"), "left").drop("_id")
    return joined.filter(F.col("lake_lsn").isNull() | (F.col("lake_lsn") < F.col("lsn")))


def collapsed(letters: DataFrame) -> DataFrame:
    """Of letters with the same id and lsn the one with the smallest offset."""
    w = Window.partitionBy("transaction_id", "lsn").orderBy("offset")
    return letters.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def open_counts(letters: DataFrame, lake: DataFrame, source: DataFrame) -> DataFrame:
    """messages, open (distinct id and lsn) and missing: ids that the source has and the lake doesn't.

    Each side is read once: letters are counted by id and lsn, meet the lake's and the source's rows of their id, and are counted again.
    """
    each = letters.groupBy("transaction_id", "lsn").agg(F.count(F.lit(1)).alias("_n"))
    held = lake.select(F.col("transaction_id").alias("_id"), F.col("lsn").alias("_held")).groupBy("_id").agg(F.max("_held").alias("_held"), F.lit(True).alias("_known"))
    there = source.select(F.col("transaction_id").alias("_own")).filter("_own is not null").distinct()
    told = each.join(held, F.col("transaction_id") == F.col("_id"), "left").join(there, F.col("transaction_id") == F.col("_own"), "left")
    waiting = F.col("_held").isNull() | (F.col("_held") < F.col("lsn"))
    by_id = told.groupBy("transaction_id").agg(
        F.sum("_n").alias("_n"), F.count_if(waiting).alias("_open"), F.max(F.when(waiting & F.col("_held").isNull() & F.col("_own").isNotNull(), 1).otherwise(0)).alias("_lost")
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return by_id.agg(total("_n").alias("messages"), total("_open").alias("open"), total("_lost").alias("missing"))


#: Fixed value: ids that a source of UUIDs can be asked for, of any version and case.
ANY_UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def present(ids: DataFrame, source: DataFrame) -> DataFrame:
    """Those of the ids that the source has; malformed ones aren't asked for."""
    return ids.filter(F.col("transaction_id").rlike(ANY_UUID)).join(source.select("transaction_id"), "transaction_id", "left_semi")


def watermarks(messages: DataFrame) -> DataFrame:
    """One row: low (the first offset), high (behind the last) and their distance; an empty log has zeros."""
    ends = messages.agg(F.coalesce(F.min("offset"), F.lit(0)).alias("low"), F.coalesce(F.max("offset") + 1, F.lit(0)).alias("high"))
    return ends.withColumn("messages", F.col("high") - F.col("low"))


def get(messages: DataFrame, offset: int) -> DataFrame:
    """The parsed message at an offset, if it is there."""
    return parse(messages.filter(F.col("offset") == offset))


def scan(messages: DataFrame, start: int, most: int) -> DataFrame:
    """The first `most` parsed messages from an offset on, with `next` (where to go on; the end, if none is left) and `end`."""
    ends = watermarks(messages).select(F.col("high").alias("end"))  # one row
    ahead = messages.filter(F.col("offset") >= start).orderBy("offset").limit(most)
    last = ahead.agg((F.max("offset") + 1).alias("_next"))
    told = parse(ahead).join(F.broadcast(last), F.lit(True)).join(F.broadcast(ends), F.lit(True))
    return told.withColumn("next", F.coalesce("_next", "end")).drop("_next")


def missing_open(letters: DataFrame, lake: DataFrame, source: DataFrame) -> DataFrame:
    """Distinct ids of open letters that the lake has never had and the source has."""
    gone = open_letters(letters, lake).filter("lake_lsn is null").select("transaction_id").distinct()
    return gone.join(source.select("transaction_id"), "transaction_id", "left_semi")


def with_reason(letters: DataFrame, part: str) -> DataFrame:
    """Letters whose reasons contain a part, whatever its case; parts that no reason can contain are an error."""
    if not re.fullmatch("[A-Z_,]{0,64}", part.upper()):
        raise ValueError(f"not a part of a reason: {part!r}")
    return letters.filter(F.col("rejection_reason").contains(part.upper()))


def page(letters: DataFrame, cursor: int = 0, limit: int = 50, most: int = 200) -> DataFrame:
    """One page from an offset on, with the cursor of the next ('' at the end); limits are held to 1..most."""
    limit = min(max(limit, 1), most)
    ahead = letters.filter(F.col("offset") >= cursor).orderBy("offset").limit(limit + 1)  # one more tells if there is a next
    w = Window.orderBy("offset")
    told = ahead.withColumn("_n", F.row_number().over(w)).withColumn("_next", F.max(F.when(F.col("_n") == limit + 1, F.col("offset"))).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return told.filter(F.col("_n") <= limit).withColumn("next_cursor", F.coalesce(F.col("_next").cast("string"), F.lit(""))).drop("_n", "_next")


def revalidated(letters: DataFrame, merchants) -> DataFrame:
    """Letters with the reasons that today's rules have against them (empty: none)."""
    return judged(letters.withColumn("is_delete", F.col("op") == "d").drop("rejection_reason"), merchants)


def replay_class(letters: DataFrame, lake: DataFrame, merchants) -> DataFrame:
    """What replaying each letter would do: ALREADY_APPLIED, STILL_INVALID or REPLAYABLE, in this order."""
    held = lake.select(F.col("transaction_id").alias("_id"), F.col("lsn").alias("lake_lsn"))
    told = revalidated(letters, merchants).join(held, F.col("transaction_id") == F.col("_id"), "left").drop("_id")
    applied = F.coalesce(F.col("lake_lsn") >= F.col("lsn"), F.lit(False))
    return told.withColumn("replay_class", F.when(applied, "ALREADY_APPLIED").when(F.col("rejection_reason") != "", "STILL_INVALID").otherwise("REPLAYABLE"))
