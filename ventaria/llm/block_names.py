"""Exact duplicates by deterministic block naming, in DataFrame operations only.

A text is normalised (each run of ``[\\x20\\x09-\\x0D]`` becomes one space) and
cut into blocks of ``block_bytes`` bytes. Blocks are sorted and numbered: equal
blocks get one integer name, different blocks different ones. Then adjacent
names are paired, the pairs sorted and numbered in turn, until a text is one
name; a last name without a neighbour is paired with 0, which is no name. Texts
are equal exactly if they end in one name on one level.

Names are collision-free, though blocks travel once and are then known by their
64-bit hash: sorting by hash brings all blocks of one hash together, and only a
hash whose least and greatest block are equal names a block by itself. Should one hash be
contested, all blocks are sorted and named by their bytes. A name used once in the
whole corpus proves its text unique, so after the first level only texts made of
repeated blocks go on.

Hot names: a name that covers more than one in 10,000 of the rows on its level is
joined by broadcast, and there are fewer than 10,000 of them whatever the input;
all others are joined by shuffle. Blocks are pre-aggregated in each task before
they move, so a text of any frequency sends one row a task.

Defined results: a null text is an empty text, equal to other empty ones; blank
texts of any length equal one space. Of equal texts the row of the smallest id
stays; a null id comes after all others; of repeated rows of that id, or of rows
all without one, exactly one stays. Two rows of one id with different texts are
judged each by its own text. An empty table gives an empty result; columns other
than doc_id and text are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ventaria.llm import text as T
from ventaria.llm.rules import held
from ventaria.session import settle

BLANKS = r"[\x20\x09-\x0D]+"
HOT_SHARE = 10_000


@dataclass(frozen=True)
class Settings:
    block_bytes: int = 512
    hash_bits: int = 64  # fewer only in tests, to make different blocks share a hash


def normalised(docs: DataFrame) -> Column:
    return F.regexp_replace(F.coalesce(docs["text"].cast("string"), F.lit("")), BLANKS, " ")


def block_hash(block: Column, settings: Settings) -> Column:
    return F.shiftright(F.xxhash64(block), 64 - settings.hash_bits)


def blocks_of(docs: DataFrame, settings: Settings, *kept: Column) -> DataFrame:
    """``kept`` columns and ``blocks``, the normalised text in byte blocks; an empty text is one empty block."""
    size = settings.block_bytes
    whole = held(docs.select(*kept, normalised(docs).cast("binary").alias("bytes")))
    last = F.ceil(F.octet_length("bytes") / size).cast("int") - 1
    return whole.select("*", F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                                         lambda i: F.substring(F.col("bytes"), i * size + 1, F.lit(size))).alias("blocks"))


def numbered(sorted_rows: DataFrame) -> DataFrame:
    """A name above 0 for each row, rising inside each sorted range; written, so that a retried task cannot rename."""
    return settle(sorted_rows.withColumn("name", F.monotonically_increasing_id() + 1))


def attach(rows: DataFrame, names: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` with ``name`` and its count ``n``; frequent names by a broadcast of at most HOT_SHARE rows."""
    frequent = F.col("n") * HOT_SHARE > total
    few = F.broadcast(names.where(frequent).select(*keys, F.col("name").alias("hot_name"), F.col("n").alias("hot_n")))
    tried = rows.join(few, keys, "left")
    hot = tried.where(F.col("hot_name").isNotNull()).withColumnsRenamed({"hot_name": "name", "hot_n": "n"})
    usual = names.where(~frequent).select(*keys, "name", "n")
    rest = tried.where(F.col("hot_name").isNull()).drop("hot_name", "hot_n").join(usual, keys)
    return hot.unionByName(rest)


def sequences(named: DataFrame) -> DataFrame:
    """row, level and the text's names in order, without texts that hold a name used once."""
    folded = named.groupBy("row", "level").agg(F.sort_array(F.collect_list(F.struct("at", "name"))).alias("names"), F.min("n").alias("rarest"))
    return folded.where("rarest > 1").select("row", "level", F.col("names.name").alias("names"))


def names_by_hash(docs: DataFrame, settings: Settings) -> DataFrame:
    """hash, name, n, and whether different blocks share the hash; the only shuffle of block bytes."""
    every = blocks_of(docs, settings).select(F.explode("blocks").alias("block"))
    by_hash = every.groupBy(block_hash(F.col("block"), settings).alias("hash")).agg(
        F.min("block").alias("least"), F.max("block").alias("greatest"), F.count("*").alias("n"))
    return numbered(by_hash.sortWithinPartitions("hash").select("hash", (F.col("least") != F.col("greatest")).alias("contested"), "n"))


def first_level(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The rows (row, doc_id, text_sha256), and names of level 0 for every text of which no block is unique.

    ``row`` is given once and written. Should different blocks share a hash, all
    blocks are written and named by their bytes instead.
    """
    names = names_by_hash(docs, settings)
    cut = blocks_of(docs, settings, F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"))
    cut = cut.withColumn("text_sha256", F.sha2("bytes", 256))
    level = F.lit(0).alias("level")
    if names.where("contested").isEmpty():
        rows = settle(cut.select("row", "doc_id", "text_sha256", F.transform("blocks", lambda b: block_hash(b, settings)).alias("blocks")))
        places = rows.select("row", level, F.posexplode("blocks").alias("at", "hash"))
        told = attach(places, names, ["hash"], names.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    else:
        rows = settle(cut.select("row", "doc_id", "text_sha256", "blocks"))
        places = rows.select("row", level, F.posexplode("blocks").alias("at", "block"))
        by_bytes = places.groupBy("block").agg(F.count("*").alias("n"))
        told = attach(places, numbered(by_bytes.sortWithinPartitions("block")), ["block"], places.count())
    return rows.drop("blocks"), settle(sequences(told))


def name_pairs(open_texts: DataFrame) -> DataFrame:
    """The next level: adjacent names in pairs, pairs sorted and named."""
    half = F.floor((F.size("names") + 1) / 2).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), half - 1), lambda i: F.struct(
        F.get("names", 2 * i).alias("left"), F.coalesce(F.get("names", 2 * i + 1), F.lit(0)).alias("right")))
    placed = settle(open_texts.select("row", (F.col("level") + 1).alias("level"), F.posexplode(pairs).alias("at", "pair"))
                    .select("row", "level", "at", "pair.left", "pair.right"))
    names = numbered(placed.groupBy("left", "right").agg(F.count("*").alias("n")).sortWithinPartitions("left", "right"))
    return settle(sequences(attach(placed, names, ["left", "right"], placed.count())))


def identities(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, text_sha256), and the identity (level, name) of each row whose blocks all stand twice or more."""
    rows, level = first_level(docs, settings)
    done = level.where(F.size("names") == 1)
    while True:
        level = level.where(F.size("names") > 1)
        if level.isEmpty():
            return rows, done.select("row", "level", F.col("names")[0].alias("name"))
        level = name_pairs(level)
        done = done.unionByName(level.where(F.size("names") == 1))


def group_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, known = identities(docs, settings)
    member = settle(rows.select("row", "doc_id").join(known, "row"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = settle(member.groupBy("level", "name").agg(first.alias("first"), F.count("*").alias("n")))
    several = groups.where("n > 1").select("level", F.col("name").alias("text_name"), "n", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"))
    told = attach(member.withColumnRenamed("name", "text_name"), several.withColumn("name", F.struct("keep_id", "keep_row")), ["level", "text_name"], member.count())
    told = told.select("row", F.col("name.keep_id").alias("keep_id"), F.col("name.keep_row").alias("keep_row"), F.col("n").alias("group_size"))
    joined = rows.join(told, "row", "left")
    alone = F.col("group_size").isNull()
    return joined.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                         F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                         (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_copies(T.documents(spark, sf_dir))


OP11_SQL = r"""
WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
grouped AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM texts)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM grouped
"""
