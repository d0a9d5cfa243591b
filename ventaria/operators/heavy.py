"""Lookup joins that know their heavy keys.

A shuffled join sends all rows of a key to one task. A lookup whose size has been
checked is broadcast; for a larger one a mergeable sketch counts the keys of the rows first (bounded per task, whatever the number of
keys); keys that may hold more than ``SHARE`` of the rows are joined by a
broadcast of their lookup rows, of which there are at most as many as such keys,
and all other rows meet by shuffle. The sketch only decides which way a row
goes: both ways give the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ventaria.functions.expressions import all_of
from ventaria.session import by_key, settle

SHARE = 1_000  # a key is heavy from one in so many rows
TRACKED = 10_000  # keys a sketch keeps
MOST_BYTES = 10 << 20  # of a lookup that is broadcast whole


def key_hash(columns: list[Column]) -> Column:
    return F.xxhash64(*columns)


def heavy_hashes(rows: DataFrame, columns: list[str], share: int = SHARE) -> list[int]:
    """Hashes of the keys that may hold one in ``share`` rows; at most ``TRACKED`` numbers reach the driver."""
    known = rows.where(all_of([F.col(c).isNotNull() for c in columns])).select(key_hash([F.col(c) for c in columns]).alias("h"))
    found = known.agg(F.expr(f"approx_top_k(h, {min(2 * share, TRACKED // 2)}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [k["item"] for k in found["top"] or [] if k["count"] * share > found["n"]]


def bytes_of(lookup: DataFrame) -> int:
    """Bytes of all rows as text."""
    return lookup.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*lookup.columns)))), F.lit(0))).first()[0]


def fetch_home(rows: DataFrame, lookup: DataFrame, match: dict[str, str], home: str) -> DataFrame:
    """Left join of a lookup with rows parted by ``home``: only their distinct keys and the lookup rows move."""
    keys = list(match)
    if home in match:
        found, same = by_key(lookup, match[home]), all_of([F.col(c) == F.col(m) for c, m in match.items()])
    else:
        asked = rows.where(all_of([F.col(c).isNotNull() for c in keys])).select(F.col(home).alias("_h"), *[F.col(c).alias(f"_a{n}") for n, c in enumerate(keys)]).distinct()
        found = by_key(asked.join(lookup, all_of([F.col(f"_a{n}") == F.col(match[c]) for n, c in enumerate(keys)])), "_h")
        same = all_of([F.col(home) == F.col("_h"), *[F.col(c) == F.col(f"_a{n}") for n, c in enumerate(keys)]])
    return rows.join(found.hint("shuffle_hash"), same, "left").select(*rows.columns, *lookup.columns)


def join_lookup(rows: DataFrame, lookup: DataFrame, match: dict[str, str], share: int = SHARE, most_bytes: int = MOST_BYTES,
                home: str | None = None, homeless: bool = True) -> DataFrame:
    """Left join of a lookup with one row per key, ``match`` = {column of the rows: column of the lookup}; unknown keys match nothing.

    A lookup of at most ``most_bytes`` is broadcast whole, and no row moves. Beyond
    that the rows are written once and part by the weight of their key; rows
    settled in buckets of ``home`` stay there, and their distinct keys fetch the
    lookup rows instead. With ``homeless`` some rows may have no home; the union
    with them is no longer known to be parted by it.
    """
    lookup = settle(lookup)
    mine, theirs = [F.col(c) for c in match], [F.col(c) for c in match.values()]
    same = all_of([a == b for a, b in zip(mine, theirs)])
    if bytes_of(lookup) <= most_bytes:
        return rows.join(F.broadcast(lookup), same, "left")
    if home in match or (home and not homeless):
        return fetch_home(rows, lookup, match, home)
    if home:
        away = join_lookup(rows.where(F.col(home).isNull()), lookup, match, share, most_bytes)
        return fetch_home(rows.where(F.col(home).isNotNull()), lookup, match, home).unionByName(away)
    rows = settle(rows)
    heavy = heavy_hashes(rows, list(match), share)
    if not heavy:
        return rows.join(lookup, same, "left")
    whole = all_of([c.isNotNull() for c in mine])
    crowd = whole & key_hash(mine).isin(heavy)
    few = F.broadcast(lookup.where(key_hash(theirs).isin(heavy)))  # one row for each heavy key
    return rows.where(crowd).join(few, same, "left").unionByName(rows.where(~crowd).join(lookup, same, "left"))
