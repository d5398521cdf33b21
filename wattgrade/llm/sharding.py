"""Sharding by sampled splitters; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattgrade.llm.common import hash60, numbered
from wattgrade.session import staged

LAW = "bytes"
TOP = "g" * 32  # above every key of hexadecimal digits
PREFIX = 3  # hexadecimal digits by which keys find their range


def sort_key(doc_id: Column, text: Column) -> Column:
    """32 hexadecimal digits: sixteen of the text, then sixteen of the id, so equal texts lie side by side."""
    return F.concat(
        F.substring(F.md5(F.coalesce(F.concat(F.lit("t"), text), F.lit(""))), 1, 16),
        F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 16),
    )


def in_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows (key) with the range (low, high) they fall into.

    A range is listed under each key prefix it touches, so an equality join with a test of the ends places a key. The
    list has at most a row per range and one per prefix, a number fixed by the parameters, and may be broadcast.
    """
    number = lambda c: F.conv(F.regexp_replace(F.substring(c, 1, PREFIX), "g", "f"), 16, 10).cast("int")
    listed = ranges.select("low", "high", F.explode(F.sequence(number("low"), number("high"))).alias("prefix"))
    placed = rows.withColumn("prefix", number("key")).join(F.broadcast(listed), "prefix")
    return placed.where("key >= low and key < high").drop("prefix")


def as_ranges(splitters: DataFrame) -> DataFrame:
    """(low, high) between neighbouring splitters. Their number is bounded by the parameters."""
    cuts = splitters.select("cut").distinct()
    ordered = Window.orderBy("cut")
    return cuts.select(F.col("cut").alias("low"), F.lead("cut", 1, TOP).over(ordered).alias("high"))


def shard_pieces(ranges: DataFrame, shards: int, total: int) -> DataFrame:
    """(low, high, shard, start, n, first): which places of the sorted rows go to which shard, from slot ``first`` on.

    A range goes as a whole to the shard in which its middle byte lies. Only a range of equal rows, which no splitter
    can divide, is cut by number where shards end. All windows run over the ranges, whose number the parameters bound.
    """
    before = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    ranges = ranges.select(
        "low", "high", "bytes", "n", (F.col("keys_low") == F.col("keys_high")).alias("equal"),
        earlier("bytes").alias("byte"), earlier("n").alias("at"),
    )
    per_shard, each = max(1, total) / shards, F.col("bytes") / F.col("n")
    in_shard = lambda byte: F.least(F.floor(byte / F.lit(per_shard)), F.lit(shards - 1))
    middle = in_shard(F.col("byte") + F.col("bytes") / 2)
    from_, to = in_shard(F.col("byte") + each / 2), in_shard(F.col("byte") + F.col("bytes") - each / 2)
    ranges = ranges.withColumn("from", F.when(F.col("equal"), from_).otherwise(middle))
    ranges = ranges.withColumn("to", F.when(F.col("equal"), to).otherwise(middle))
    cut = ranges.withColumn("shard", F.explode(F.sequence("from", F.greatest("from", "to"))))
    # The first row of the group whose middle byte lies in a shard.
    first_row = lambda s: F.ceil((s * F.lit(per_shard) - F.col("byte")) / each - 0.5)
    begin = F.when(F.col("shard") == F.col("from"), 0).otherwise(first_row(F.col("shard")))
    end = F.when(F.col("shard") >= F.col("to"), F.col("n")).otherwise(first_row(F.col("shard") + 1))
    cut = cut.withColumn("begin", begin).withColumn("n", end - begin).where("n > 0")
    filled = Window.partitionBy("shard").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    return cut.select(
        "low",
        "high",
        F.col("shard").cast("int").alias("shard"),
        (F.col("at") + F.col("begin")).alias("start"),
        "n",
        F.coalesce(F.sum("n").over(filled), F.lit(0)).alias("first"),
    )


def shard(
    docs: DataFrame,
    shards: int = 24,
    doc_id: str = "doc_id",
    text: str = "text",
    ranges_per_shard: int = 64,
    draws: int = 8,
    rounds: int = 3,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size-weighted samples of the keys give the splitters of ``shards * ranges_per_shard`` ranges. All rows are
    measured against them, and ranges over twice their share are divided by samples drawn inside them: first between
    texts, in the last round also inside a group of equal texts. Consecutive ranges then fill the shards, so shard
    sizes differ by about a range, 1/64 of a shard. Equal texts share a shard unless they outgrow two ranges.

    Null texts have the size 8 and the checksum of the empty text; null ids are allowed. Rows equal in id and text take
    different slots and are interchangeable; a range of them is cut by number where a shard is full, so however many they
    are, shards stay near equal. An empty table gives an empty table.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        sort_key(F.col(doc_id), F.col(text)).alias("key"),
    )
    rows = staged(rows, "shard-keys")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    pieces = shards * ranges_per_shard
    share = max(1.0, total / pieces)
    spark = rows.sparkSession
    start = spark.range(1).select(F.lit("0" * 32).alias("cut"))
    ranges, per_range = None, None
    for step in range(rounds + 1):
        chance = hash60(F.concat("key", F.lit(f":{step}"))) / float(1 << 60)
        group_start = F.rpad(F.substring("key", 1, 16), 32, "0")
        if ranges is None:
            drawn = rows.where(chance < F.col("size") * (draws / share)).select(
                F.lit("").alias("low"), "key", F.array(group_start).alias("cut")
            )
        else:
            whole_groups = step < rounds
            over = per_range.where(F.col("bytes") > 2 * share)
            if whole_groups:
                over = over.where("texts_low < texts_high")
            over = staged(over.select("low", "high", "bytes"), "shard-over")
            if over.isEmpty():
                if whole_groups:
                    continue
                break
            inside = in_ranges(rows, over.select("low", "high")).join(F.broadcast(over.drop("high")), "low")
            # A cut before what is drawn and one behind it, so that a large group gets a range of its own.
            group_end = F.concat(F.substring("key", 1, 16), F.lit("g"))
            ends = (group_start, group_end) if whole_groups else (F.col("key"), F.concat("key", F.lit("0")))
            drawn = inside.where(chance < F.col("size") * (draws / share)).select(
                "low", "key", F.array(*ends).alias("cut")
            )
        # Quantiles of the sample: every draws-th key becomes a cut.
        position = F.row_number().over(Window.partitionBy("low").orderBy("key"))
        cuts = drawn.withColumn("position", position).where(F.col("position") % draws == 0)
        cuts = cuts.select(F.explode("cut").alias("cut"))
        old = start if ranges is None else ranges.select(F.col("low").alias("cut"))
        ranges = staged(as_ranges(old.unionByName(cuts)), "shard-ranges")
        text_part = F.substring("key", 1, 16)
        per_range = staged(
            in_ranges(rows, ranges)
            .groupBy("low", "high")
            .agg(
                F.sum("size").alias("bytes"),
                F.count("*").alias("n"),
                F.min(text_part).alias("texts_low"),
                F.max(text_part).alias("texts_high"),
                F.min("key").alias("keys_low"),
                F.max("key").alias("keys_high"),
            ),
            "shard-bytes",
        )
    pieces = staged(shard_pieces(per_range, shards, total), "shard-map")
    # Equal rows are numbered too, by where they lie, so that a group of them can be cut by number.
    placed = numbered(rows.withColumn("tie", F.monotonically_increasing_id()), "place", F.col("key"), F.col("tie"))
    found = in_ranges(placed, pieces.select("low", "high").distinct()).join(F.broadcast(pieces.drop("high")), "low")
    found = found.where("place >= start and place < start + n")
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("first") + F.col("place") - F.col("start")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
