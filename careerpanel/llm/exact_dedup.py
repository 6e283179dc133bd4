"""Exact deduplication by naming blocks and pairs of names with integers. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerpanel.llm.common import text_or_empty
from careerpanel.sources.staging import stage

#: Bytes of a block.
BLOCK = 4096


#: Runs of white space other than a single space: what has to be replaced.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text_col: str) -> Column:
    """The text with each run of white space made one space; null is empty."""
    return F.regexp_replace(text_or_empty(text_col), RUNS, " ")


def _blocks(text: Column) -> Column:
    """The text's bytes in consecutive blocks of BLOCK; an empty text is one empty block.

    A block of bytes is cut out at its place, while one of characters would be counted up to from the start. The
    bytes are bound once, as the one element of an array, and not taken anew for each block.
    """
    n = F.greatest(F.lit(1), F.ceil(F.octet_length(text) / BLOCK)).cast("int")
    places = F.sequence(F.lit(0), n - 1)
    return F.transform(F.array(text.cast("binary")), lambda raw: F.transform(places, lambda i: F.substring(raw, i * BLOCK + 1, F.lit(BLOCK))))[0]


def _prints(block: Column, seed: int) -> list[Column]:
    """128 bits by which a block is looked up; ``name_blocks`` makes sure that no two blocks share them."""
    return [F.xxhash64(F.lit(seed), block).alias("h1"), F.xxhash64(block, F.lit(seed + 1)).alias("h2")]


def _named(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Distinct rows sorted, and each given an integer of its own by its place."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def name_blocks(texts: DataFrame, text: Column) -> tuple[DataFrame, int]:
    """(h1, h2, name): one integer per distinct block of all texts, and the seed of the look-up key.

    Distinct blocks come from whole texts compared as texts; the look-up key only finds a block's name
    again without moving its text twice. If two blocks ever shared a key, another seed is taken.
    """
    seed = 0
    while True:
        blocks = texts.select(text.alias("text")).select(F.explode(_blocks(F.col("text"))).alias("block")).groupBy("block").agg(F.lit(1).alias("one"))
        names = stage(_named(blocks, ["block"]).select(*_prints(F.col("block"), seed), "name"), "blocks")
        if names.groupBy("h1", "h2").count().where("count > 1").isEmpty():
            return names, seed
        seed += 2


def identities(docs: DataFrame, text: Column, carry: dict[str, Column]) -> DataFrame:
    """(rid, text_sha256, size, name, and ``carry``) of every row: texts are equal if and only if (size, name) are.

    The blocks of a text are named, then neighbouring names in pairs, and the names of these pairs, until
    one is left. Names of a round are the places of the round's distinct pairs in sorted order, written
    once, so they hold whatever is run again. Each round has at most half of the names of the one before.
    ``size`` is the number of blocks, so texts of unlike depth never meet.
    """
    names, seed = name_blocks(docs, text)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), *(c.alias(k) for k, c in carry.items()), text.alias("text"))
    rows = rows.select("rid", *carry, F.sha2("text", 256).alias("text_sha256"), _blocks(F.col("text")).alias("blocks"))
    rows = rows.withColumns({"prints": F.transform("blocks", lambda b: F.struct(*_prints(b, seed))), "size": F.size("blocks")}).drop("blocks")
    rows = stage(rows, "prints")
    level = rows.select("rid", "size", F.posexplode("prints").alias("at", "print")).select("rid", "size", "at", "print.*")
    level = stage(level.join(names, ["h1", "h2"]).select("rid", "size", "at", "name"), "names")
    done = level.where("size = 1").select("rid", "name")
    left = level.where("size > 1").select("rid", "size", "at", "name")
    most = rows.agg(F.max("size")).first()[0] or 1
    while most > 1:
        half = F.floor(F.col("at") / 2).cast("int")
        name = {i: F.max(F.when(F.col("at") % 2 == i, F.col("name"))) for i in (0, 1)}
        pairs = left.groupBy("rid", "size", half.alias("at")).agg(name[0].alias("a"), F.coalesce(name[1], F.lit(-1)).alias("b"))
        pairs = stage(pairs, "pairs")
        known = stage(_named(pairs.select("a", "b").distinct(), ["a", "b"]), "pair-names")
        left = pairs.join(known, ["a", "b"]).select("rid", F.ceil(F.col("size") / 2).cast("int").alias("size"), "at", "name")
        left = stage(left, "names")
        done = done.unionByName(left.where("size = 1").select("rid", "name"))
        left = left.where("size > 1")
        most = -(-most // 2)
    return rows.drop("prints").join(done, "rid")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row, dropped ones too.

    Texts are equal when they are after each run of white space is made one space. Null counts as empty.
    Of equal texts the row with the smallest id stays, null ids last; of rows with equal text and id one
    stays. Columns other than id and text are not read, whatever they are called. A block is compared whole
    and a text of any length is many blocks. A group of copies of any size is summed before it moves; the
    look-ups of names and of groups are plain joins, which Spark splits where a key is hot.
    """
    text = normalised(text_col)
    rows = identities(docs, text, {"id": F.col(id_col)})
    rows = stage(rows.select("rid", "id", "text_sha256", "size", "name"), "identities")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid"))
    groups = stage(rows.groupBy("size", "name").agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
    return rows.join(groups, ["size", "name"]).select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one per group of equal texts."""
    kept = exact_dedup(docs, id_col, text_col).where("kept")
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.sha2(normalised(text_col), 256))
    stay = kept.select(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), "text_sha256").alias("_row"))
    return docs.withColumn("_row", key).join(stay, "_row", "left_semi").dropDuplicates(["_row"]).drop("_row")
