"""Mixing sources to target weights with hash-threshold histograms; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattgrade.llm.common import hash60, numbered, word_count
from wattgrade.session import staged

STEP_BITS = 12  # one histogram has 4096 buckets a source
BITS = 60


def document_hash(doc_id: Column, text: Column) -> Column:
    """Depends on id and text alone, so reruns agree."""
    return hash60(
        F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    )


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[int], share: tuple[int, int], cap: int
) -> DataFrame:
    """(source, source_size, target) from (source, size) rows, one per source.

    Sources ordered by code point, null last, take the weights in turn. They share ``share`` (a fraction) of all
    sizes by weight; a target stops at ``cap`` times its source's size and the excess is shared anew by weight until
    no target is above. Each round brings three sums to the driver, whatever the number of sources.
    """
    by_source = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    ranked = numbered(by_source, "rank", F.col(source).asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = staged(ranked.withColumn("weight", weight.cast("long")), "mix-sources")
    part, whole = share
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    capped = F.lit(False)
    known = -1
    while True:
        row = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weights"),
            F.count(F.when(capped, 1)).alias("n"),
        ).first()
        rest, pool = part * row["total"] - whole * cap * row["full"], row["weights"]  # rest is in 1/whole words
        if row["n"] == known or not pool:
            break
        known = row["n"]
        # A source whose share of the rest passes its cap stays at the cap in all later rounds.
        capped = capped | (exact("source_size") * (cap * whole * pool) < exact("weight") * F.lit(rest))
    target = F.when(capped, (F.col("source_size") * cap).cast("double")).otherwise(
        (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(whole * (pool or 1)))
    )
    return staged(ranked.select(source, "source_size", target.alias("target")), "mix-targets")


def copy_rule(docs: DataFrame, targets: DataFrame, source: str, size: str, hashed: str) -> DataFrame:
    """Per source: copies of every document (base), the hash up to which documents get one copy more (last), and the
    hash (edge) of which only some rows (more of them) do, since equal rows are interchangeable.

    Histograms of size by source and hash bucket give the bucket in which the budget left by whole copies runs out.
    Only the rows of that bucket are counted again, in finer buckets, until the bucket holds one hash. Of its rows as
    many get one copy more as bring the words nearest to the target.
    """
    plan = targets.withColumn(
        "base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("budget", F.col("target") - F.col("base") * F.col("source_size"))
    same = lambda a, b: a[source].eqNullSafe(b[source])
    rows = docs.select(source, size, hashed)
    rules: list[DataFrame] = []
    # before: words of the source below the bucket in question.
    open_ = plan.select(source, "budget", F.lit(0).cast("long").alias("before"))
    for shift in range(BITS - STEP_BITS, -1, -STEP_BITS):
        bucket = F.shiftright(F.col(hashed), shift)
        counts = rows.groupBy(source, bucket.alias("bucket")).agg(
            F.sum(size).alias("words"), F.min(hashed).alias("low"), F.max(hashed).alias("high"), F.count("*").alias("n")
        )
        counts = counts.alias("c").join(
            open_.alias("o"), F.col(f"c.{source}").eqNullSafe(F.col(f"o.{source}"))
        ).select(f"c.{source}", "bucket", "words", "low", "high", "n", "budget", "before")
        running = Window.partitionBy(source).orderBy("bucket")
        counts = counts.withColumn("end", F.col("before") + F.sum("words").over(running))
        counts = counts.withColumn("start", F.col("end") - F.col("words"))
        edge = staged(counts.where("start <= budget and budget < end"), "mix-edge")
        each = F.col("words") / F.col("n")  # rows of one hash are equal
        fit = F.floor((2 * F.col("budget") - 2 * F.col("start") + each) / (2 * each))
        done = edge.where("low = high").withColumn("more", F.greatest(F.lit(0), F.least(F.col("n"), fit)))
        part = F.col("more").between(1, F.col("n") - 1)
        done = done.select(
            source,
            F.when(F.col("more") == F.col("n"), F.col("low")).otherwise(F.col("low") - 1).alias("last"),
            F.when(part, F.col("low")).alias("edge"),
            F.when(part, F.col("more")).alias("more"),
        )
        rules.append(done)
        finer = edge.where("low < high")
        if finer.isEmpty():
            break
        open_ = finer.select(source, "budget", F.col("start").alias("before"))
        limits = finer.select(F.col(source).alias("_source"), F.col("low").alias("_low"), F.col("high").alias("_high"))
        rows = staged(
            rows.join(
                limits,
                F.col(source).eqNullSafe(F.col("_source"))
                & (F.col(hashed) >= F.col("_low"))
                & (F.col(hashed) <= F.col("_high")),
            ).select(source, size, hashed),
            "mix-boundary",
        )
    found = rules[0]
    for more in rules[1:]:
        found = found.unionByName(more)
    # Without an edge the whole source fits into its budget, which happens only when there are no words to give.
    joined = plan.join(found, same(plan, found), "left").select(
        plan[source],
        "source_size",
        "target",
        F.col("base").cast("int").alias("base"),
        F.coalesce("last", F.lit(-1)).alias("last"),
        "edge",
        "more",
    )
    return staged(joined, "mix-rule")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: tuple[int, int] = (3, 2),
    cap: int = 2,
    name: str = "mix",
) -> DataFrame:
    """``docs`` with ``name``: struct(size, source_size, target, copies, taken).

    Sizes count words; null and empty texts have size 0 and take 0 words. ``taken`` is ``copies * size``, copies are
    0 to ``cap``. A null source is a source of its own, a null id hashes by its text. Rows equal in source, id and text
    are interchangeable: how many of them get one copy more is fixed, which of them is not. An empty table gives an empty
    table. All other columns stay, whatever their names but ``name``.
    """
    plain = docs.select(
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        document_hash(F.col(doc_id), F.col(text)).alias("hash"),
    )
    # Source, size and hash are all that the histograms need; the texts are not read again for them.
    plain = staged(plain, "mix-sizes")
    rule = copy_rule(plain, source_targets(plain, "source", "size", weights, share, cap), "source", "size", "hash")
    names = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(
        *[F.col(c).alias(n) for c, n in names.items()],
        word_count(F.col(text)).alias("size"),
        document_hash(F.col(doc_id), F.col(text)).alias("hash"),
    )
    joined = inner.join(rule, inner[names[source]].eqNullSafe(rule["source"]), "left")
    number = F.lit(None).cast("long")
    if not rule.where("more is not null").isEmpty():
        # Rows of a source's edge hash, which are its equal rows, are written once and numbered.
        at_edge = F.col("hash").eqNullSafe(F.col("edge"))
        edge = staged(joined.where(at_edge).withColumn("tie", F.monotonically_increasing_id()), "mix-edge-rows")
        edge = numbered(edge, "number", F.col(names[source]), F.col("tie"))
        first = edge.groupBy(F.col(names[source]).alias("named")).agg(F.min("number").alias("first"))
        edge = edge.join(first, F.col(names[source]).eqNullSafe(F.col("named")))
        edge = edge.withColumn("number", F.col("number") - F.col("first")).drop("tie", "named", "first")
        joined = joined.where(~at_edge).withColumn("number", number).unionByName(edge)
        number = F.col("number")
    one_more = (F.col("hash") <= F.col("last")) | (number < F.col("more"))
    copies = F.col("base") + F.when(one_more, 1).otherwise(0)
    joined = joined.withColumn("copies", copies)
    return joined.select(
        *[F.col(n).alias(c) for c, n in names.items()],
        F.struct(
            "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")
        ).alias(name),
    )
