"""Address-table operators: point/state/city reads, insert-or-update split, merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalspark.functions.responses import OK, address_columns
from postalspark.operators.lookup import last_answer, latest_per_code, lookup_table
from postalspark.schemas import ADDRESS_FIELDS, EXPORT_FIELDS


def stored_addresses(responses: DataFrame, now: str) -> DataFrame:
    """The address table as the lookups build it: every found answer, one row per code.

    Every answer's own code is looked up, so no join is needed: the found answers
    map straight to stored rows (C14).
    """
    found = lookup_table(responses).where(F.col("status") == OK)
    ts = F.lit(now).cast("timestamp_ntz")
    rows = found.select("seq", *address_columns(F.struct(*[F.col(f) for f in ADDRESS_FIELDS])))
    return last_answer(rows, "cep").withColumn("created_at", ts).withColumn("updated_at", ts)


def address_by_code(addresses: DataFrame, code: str) -> DataFrame:
    """point lookup after removing hyphens and blanks from the argument."""
    clean = code.replace("-", "").replace(" ", "")
    return addresses.where(F.col("cep") == F.lit(clean)).limit(1)


def addresses_by_uf(addresses: DataFrame, uf: str, limit: int | None = None) -> DataFrame:
    """state filter, argument upper-cased; optional limit on the code order."""
    out = addresses.where(F.col("uf") == F.lit(uf.upper()))
    return out.orderBy("cep").limit(int(limit)) if limit else out


def addresses_by_city(addresses: DataFrame, city: str, limit: int | None = None) -> DataFrame:
    """exact, case-sensitive city filter; optional limit on the code order."""
    out = addresses.where(F.col("localidade") == F.lit(city))
    return out.orderBy("cep").limit(int(limit)) if limit else out


def count_addresses(addresses: DataFrame) -> DataFrame:
    """A2: row count as a one-row frame."""
    return addresses.agg(F.count(F.lit(1)).alias("total"))


def split_insert_update(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Tag each incoming row ``update`` (key exists) or ``insert`` (new key)."""
    keys = target.select(F.col("cep").alias("_t")).dropDuplicates(["_t"])
    j = incoming.join(keys, incoming["cep"] == keys["_t"], "left")
    action = F.when(F.col("_t").isNotNull(), F.lit("update")).otherwise(F.lit("insert"))
    return j.select(*incoming.columns, action.alias("action"))


def merge_addresses(target: DataFrame, source: DataFrame, now: str) -> DataFrame:
    """K9: insert new keys, replace every field of existing keys (NULLs included).

    Existing rows keep ``created_at`` and get ``updated_at = now``; new rows get both
    set to ``now``; untouched rows pass through. One full outer join on the key.
    ``source`` must hold one row per code (see ``upsert_batch``).
    """
    ts = F.lit(now).cast("timestamp_ntz")
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in EXPORT_FIELDS])
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in ADDRESS_FIELDS])
    j = t.join(s, t["t_cep"] == s["s_cep"], "full_outer")
    in_src = F.col("s_cep").isNotNull()
    cols = [F.when(in_src, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in ADDRESS_FIELDS]
    created = F.coalesce(F.col("t_created_at"), ts).alias("created_at")
    updated = F.when(in_src, ts).otherwise(F.col("t_updated_at")).alias("updated_at")
    return j.select(*cols, created, updated)


def last_rows(source: DataFrame, seq: str = "seq") -> DataFrame:
    """One row per code: the last by ``seq`` where there is one (W3), else the greatest by its fields."""
    if seq in source.columns:
        return latest_per_code(source.select("cep", seq, *ADDRESS_FIELDS[1:]), key="cep", seq=seq).drop(seq)
    return last_answer(source.select("cep", F.lit(0).alias("seq"), *ADDRESS_FIELDS[1:]), "cep")


def upsert_batch(target: DataFrame, source: DataFrame, now: str, seq: str = "seq") -> DataFrame:
    """Many rows at once; repeated keys keep the last by ``seq`` (W3), then K9."""
    return merge_addresses(target, last_rows(source, seq), now)
