"""Near-duplicate texts by BagMinHash signatures, banding and a check of the multisets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattgrade.llm.common import components, merged, slices
from wattgrade.llm.hashing import BASE, mixed, shingles
from wattgrade.session import staged

BATCH_BYTES = 1 << 18
SLACK = 1e-9  # of comparisons of counts with multiples of the threshold
BITS = 512  # of the parities of a multiset
MEETING = 16  # texts of a shingle that meet before all do


def bags(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, shingle, times it occurs in the text), sorted."""
    owner, value = shingles(texts, words)
    order = np.lexsort((value, owner))
    owner, value = owner[order].astype(np.int64), value[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (value[1:] != value[:-1])])) if len(owner) else []
    first = np.asarray(new, np.int64)
    return owner[first], value[first], np.diff(np.append(first, len(owner)))


def last_times(out: np.ndarray, m: int) -> np.ndarray:
    """Time of each set's latest register, NaN while one is empty: no later point can lower any of them."""
    return (out.reshape(-1, m).max(axis=1) >> np.uint64(32)).astype(np.uint32).view(np.float32)


def throw_points(
    out: np.ndarray, m: int, first: np.ndarray, seed: np.ndarray, gap: float, limit: np.ndarray, above: np.ndarray | None
) -> None:
    """Lowers the registers ``out[first + register]`` by the points of one piece of many shingles.

    ``gap`` is the mean time between points, ``above`` the share of the piece that a set's weight covers (None: all of
    it). Times only order the points; which point a register holds is told by its hash.
    """
    time = np.zeros(len(seed), np.float32)
    limit = limit.astype(np.float32)
    scale = np.float32(-gap)
    while len(seed):
        # Few processes take many steps at once, many take one.
        steps = max(1, min(256, 8192 // len(seed)))
        draw = mixed((seed[:, None] + BASE * np.arange(1, steps + 1, dtype=np.uint64)[None, :]).ravel())
        gaps = scale * np.log(((draw >> np.uint64(41)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-23))
        times = time[:, None] + np.cumsum(gaps.reshape(-1, steps), axis=1)
        seed = seed + np.uint64(int(BASE) * steps % (1 << 64))
        time = times[:, -1]
        row, step = np.nonzero(times <= limit[:, None])
        draw = draw[row * steps + step]
        # Time in the upper half, 32 bits of the point's hash in the lower one; other bits choose the register.
        value = (times[row, step].view(np.uint32).astype(np.uint64) << np.uint64(32)) | (draw & np.uint64(0xFFFFFFFF))
        place = mixed(draw + np.uint64(1))
        at = first[row] + (((place >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
        if above is not None:
            under = (place & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 < above[row]
            at, value = at[under], value[under]
        np.minimum.at(out, at, value)
        limit = np.fmin(limit, last_times(out, m)[first // m])
        alive = np.flatnonzero(time <= limit)
        if len(alive) < len(time):
            first, seed, time, limit = first[alive], seed[alive], time[alive], limit[alive]
            above = None if above is None else above[alive]


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """BagMinHash signatures (n x m) of weighted sets; registers agree with the sets' weighted Jaccard similarity.

    The weight axis is cut at 1, 2, 4, 8 and so on. Each piece of a shingle has a Poisson process of points whose rate
    is the piece's length and whose course depends on shingle and piece alone; a point has a time, a register and a
    height. A set keeps the points below its weights, and a register the earliest of them. Points come in order
    of time and end at the set's latest register once all are filled, at a horizon before; sets with an empty register
    then get a longer horizon.
    """
    out = np.full(n * m, np.iinfo(np.uint64).max, np.uint64)
    empty = np.iinfo(np.uint64).max
    total = np.bincount(owner, weights=weight, minlength=n)
    todo = np.flatnonzero(total > 0)
    reach = math.log(m) + 4.0
    while len(todo):
        horizon = np.zeros(n)
        horizon[todo] = m * reach / total[todo]
        low, piece = 0, 0
        mine = np.flatnonzero(horizon[owner] > 0)
        while len(mine):
            high = max(1, 2 * low)
            seed = mixed(shingle[mine] * BASE + np.uint64(piece + 1))
            above = None if low == 0 else (weight[mine] - low) / float(high - low)
            throw_points(out, m, owner[mine] * m, seed, 1.0 / (high - low), horizon[owner[mine]], above)
            horizon = np.fmin(horizon, last_times(out, m))
            mine = mine[weight[mine] > high]
            low, piece = high, piece + 1
        todo = np.flatnonzero((out.reshape(n, m) == empty).any(axis=1) & (total > 0))
        reach *= 2
    return out.reshape(n, m)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """(n x bands) keys: a hash of each band's registers and its number."""
    n, m = signature.shape
    parts = signature.reshape(n, m // rows, rows)
    key = np.broadcast_to(np.arange(1, m // rows + 1, dtype=np.uint64), (n, m // rows)).copy()
    for r in range(rows):
        key = mixed(key * BASE + (parts[:, :, r] & np.uint64(0xFFFFFFFF)))
    return key.view(np.int64)


def batches_of(texts: list[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about ``limit`` bytes together; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and (size + len(t) > limit or i - start >= 1 << 15):
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if texts:
        yield start, len(texts)


def signed(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(id, key, n, bands): id, key of the text, number of shingles, keys of the bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [t.encode() for t in part.column(2).to_pylist()]
            for low, high in batches_of(texts):
                owner, shingle, weight = bags(texts[low:high], words)
                sizes = np.bincount(owner, weights=weight, minlength=high - low).astype(np.int64)
                keys = band_keys(signatures(owner, shingle, weight, high - low, bands * rows), rows)
                lists = [k.tolist() if s else [] for k, s in zip(keys, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).slice(low, high - low),
                        part.column(1).slice(low, high - low),
                        pa.array(sizes),
                        pa.array(lists, pa.list_(pa.int64())),
                    ],
                    ["id", "key", "n", "bands"],
                )

    return docs.select("id", "key", "text").mapInArrow(run, "id long, key string, n long, bands array<long>")


def parities(owner: np.ndarray, grams: np.ndarray, n: int) -> np.ndarray:
    """(n x BITS / 64) longs: for each of BITS classes of grams whether a text has an odd number of them."""
    at = owner.astype(np.int64) * BITS + (grams.view(np.uint64) % np.uint64(BITS)).astype(np.int64)
    odd = (np.bincount(at, minlength=n * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, BITS), axis=1).view(np.int64)


def multisets(texts: DataFrame, words: int) -> DataFrame:
    """(id, grams, odd): the multiset of a text's shingles as a set of hashes of a shingle and the how-manieth it is, and
    its ``parities``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bodies = [t.encode() for t in batch.column(1).to_pylist()]
            for low, high in batches_of(bodies):
                owner, shingle, weight = bags(bodies[low:high], words)
                which = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
                grams = mixed(np.repeat(shingle, weight) * BASE + which.astype(np.uint64)).view(np.int64)
                ends = np.cumsum(np.bincount(owner, weights=weight, minlength=high - low).astype(np.int64))
                lists = pa.LargeListArray.from_arrays(np.concatenate([[0], ends]), grams).cast(pa.list_(pa.int64()))
                odd = pa.array(list(parities(np.repeat(owner, weight), grams, high - low)), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), lists, odd], ["id", "grams", "odd"])

    return texts.select("id", "text").mapInArrow(run, "id long, grams array<long>, odd array<long>")


def reaches(a: Column, b: Column, threshold: float) -> Column:
    """Whether the weighted Jaccard similarity of two multisets, their common part by the whole of both, is large enough.

    The common part stands in the condition once, since Spark would count it again for each mention.
    """
    common = F.size(F.array_intersect(a, b))
    return common * (1.0 + threshold) >= (F.size(a) + F.size(b)) * threshold - SLACK


def checked(pairs: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that share a band and whose multisets are similar enough."""
    sides = [bodies.select(F.col("id").alias(s), F.col("grams").alias(f"_{s}"), F.col("bands").alias(f"_{s}_bands")) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    similar = F.arrays_overlap("_a_bands", "_b_bands") & reaches(F.col("_a"), F.col("_b"), threshold)
    return both.where(similar).select("a", "b")


def rare_grams(bodies: DataFrame, threshold: float) -> DataFrame:
    """(id, n, gram, at): the rarest grams of each multiset of n, ``at`` counting from 0 in the order of all by frequency.

    Two multisets that reach the threshold have one of these in common, the first that both hold: were it later in
    one of them, too few would be left after it.
    """
    each = bodies.select("id", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    often = each.groupBy("gram").agg(F.count("*").alias("often"))
    # The list of one text has as many entries as the text has shingles.
    listed = each.join(often, "gram").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("often", "gram"))).alias("all"))
    first = F.col("n") - F.ceil(F.col("n") * threshold - SLACK).cast("int") + 1
    rare = listed.select("id", "n", F.posexplode(F.slice("all", 1, first)).alias("at", "rare"))
    return rare.where("rare.often > 1").select("id", "n", F.col("rare.gram").alias("gram"), "at")


def may_reach(x: Column, x_at: Column, y: Column, y_at: Column, threshold: float) -> Column:
    """Whether multisets of x and y entries, whose first common one is at x_at and y_at, can reach the threshold."""
    return F.least(x - x_at, y - y_at) >= (x + y) * (threshold / (1.0 + threshold)) - SLACK


def unlike(x: Column, y: Column) -> Column:
    """Classes of grams of which two multisets have odd and even numbers: at least so many grams are in one of them only."""
    words = [F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(BITS // 64)]
    return reduce(add, words)


def meeting(x: DataFrame, y: DataFrame, place: str, threshold: float) -> DataFrame:
    """(a, b): texts of x and y, the shorter one in x, of different components that a rare gram and ``place`` bring together
    and that may reach the threshold, by the places of the gram and, where there are any, by their parities."""
    odd = "odd" in x.columns
    x, y = x.alias("x"), y.alias("y")
    of = lambda c: (F.col(f"x.{c}"), F.col(f"y.{c}"))
    (xi, yi), (xn, yn), (xa, ya), (xc, yc) = of("id"), of("n"), of("at"), of("component")
    same = (F.col("x.gram") == F.col("y.gram")) & (F.col(f"x.{place}") == F.col(f"y.{place}"))
    may = may_reach(xn, xa, yn, ya, threshold)
    if odd:
        # Twice the common part is the whole of both less what only one of them has.
        may = may & ((xn + yn - unlike(*of("odd"))) * (1.0 + threshold) >= (xn + yn) * (2.0 * threshold) - SLACK)
    met = x.join(y, same & (xc != yc) & ((xn < yn) | ((xn == yn) & (xi < yi))) & may)
    return met.select(F.least(xi, yi).alias("a"), F.greatest(xi, yi).alias("b")).distinct()


def apart(rare: DataFrame, placed: DataFrame) -> DataFrame:
    """The rare grams with their texts' components, without the grams of which all texts are in one component."""
    rows = rare.join(placed, "id")
    several = rows.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return rows.join(several.where("low != high").select("gram"), "gram")


def gram_groups(rare: DataFrame, threshold: float) -> DataFrame:
    """(a, b): as ``gram_pairs``, but the texts of a gram are dealt into groups of about ``MEETING``, which grow in number
    with them, and only those of a group meet."""
    sizes = rare.groupBy("gram").agg(F.count("*").alias("_of")).where("_of > 1")
    group = F.pmod(F.xxhash64("id", "gram"), F.ceil(F.col("_of") / MEETING))
    rows = rare.join(sizes, "gram").withColumn("group", group).drop("_of")
    return meeting(rows, rows, "group", threshold)


def gram_pairs(rare: DataFrame, threshold: float) -> DataFrame:
    """(a, b): all texts of different components whose first common rare gram lets them reach the threshold.

    The texts of a gram's largest component do not meet each other: they have keys of their own, which only the texts
    of other components look up. The shorter text of a pair needs even fewer grams than the longer one.
    """
    sizes = rare.groupBy("gram", "component").agg(F.count("*").alias("_size"))
    main = sizes.groupBy("gram").agg(F.max_by("component", F.struct("_size", "component")).alias("main"), F.count("*").alias("_of"))
    rows = rare.join(main.where("_of > 1").drop("_of"), "gram").withColumn("in_main", F.col("component") == F.col("main"))
    least = F.ceil(F.col("n") * (2.0 * threshold / (1.0 + threshold)) - SLACK)
    short = rows.where(F.col("at") <= F.col("n") - least).withColumn("key", F.col("in_main")).drop("main", "in_main")
    keys = F.when(F.col("in_main"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    long_ = rows.withColumn("key", F.explode(keys)).drop("main", "in_main")
    return meeting(short, long_, "key", threshold)


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    words: int = 5,
    bands: int = 32,
    rows: int = 5,
) -> DataFrame:
    """(key, class_id, survivor, copies) of every text, by its MD5 ``key``.

    ``class_id`` is the smallest id in the text's class of near duplicates, null when no member has one. ``survivor`` is
    the key of the class's text with the smallest id, nulls last, then the smallest key.

    Equal texts are one class. Different ones are linked when the multisets of their shingles of ``words`` words have a
    similarity of at least ``threshold``, and classes are the components of these links. 32 bands of 5 rows miss a
    pair at 0.8 with a chance of 3 in a million.

    Texts are compared and linked by numbers of their own, so neither null ids nor shared ones link unlike texts.
    Texts sharing a band are first compared with the smallest number of the band, so a large group costs one pair per
    member and band. Texts of bands whose members are then still in different classes are compared through their rarest
    shingles: first in small groups of those that have one in common, so that most near copies are in one class, then all
    that have one in common, are still in different classes and, by the places of this shingle and the parities of
    both texts, may reach the threshold. Every pair that reaches it has such a shingle, so only pairs that cannot reach
    it are left out.

    Null and empty texts and texts without words have no shingles: they are linked with equal texts only. An empty
    table gives an empty table.
    """
    plain = docs.select(
        F.col(doc_id).cast("long").alias("id"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    marked = staged(signed(plain, words, bands, rows), "bag-signatures")
    texts = marked.groupBy("key").agg(
        F.min("id").alias("doc"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.count("*").alias("copies")
    )
    # From here on ``id`` is the number of a text, fixed once it is written.
    texts = staged(texts.withColumn("id", F.monotonically_increasing_id()), "bag-texts")
    listed = texts.select("id", "n", F.explode("bands").alias("band"))
    shared = listed.groupBy("band").agg(F.min("id").alias("center"), F.count("*").alias("size")).where("size > 1")
    members = staged(listed.join(shared.drop("size"), "band"), "bag-bands")
    wanted = members.select("id").distinct()
    # Of equal texts only rows with the smallest id are read again.
    named = texts.join(wanted, "id", "left_semi").select("key", "doc", "id")
    bodies = plain.withColumnRenamed("id", "doc").join(
        named.withColumnsRenamed({"key": "_key", "doc": "_doc"}),
        (F.col("key") == F.col("_key")) & F.col("doc").eqNullSafe(F.col("_doc")),
    )
    bodies = multisets(bodies.select(named["id"], "text").distinct(), words)
    bodies = staged(bodies.join(texts.select("id", "bands"), "id"), "bag-multisets")
    # Bands of the smallest id with each other member, compared once a pair.
    stars = members.where("id != center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    links = staged(checked(stars, bodies, threshold), "bag-stars")
    joined = staged(components(links, "a", "b"), "bag-components")

    placed = members.select("band", "id").join(joined.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("band", "id", F.coalesce("component", "id").alias("component"))
    several = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = placed.join(several.where("low != high").select("band"), "band").select("id").distinct()
    open_ = staged(bodies.join(open_, "id"), "bag-open")
    rare = staged(rare_grams(open_.drop("bands"), threshold), "bag-rare-grams")
    rows = None
    for found in (gram_groups, gram_pairs):
        # Written once, since a plan that joins all this for each of its sides has a driver hold many small tables at once.
        if rows is None:
            placed = open_.select("id").join(joined.withColumnRenamed("node", "id"), "id", "left")
            rows = staged(apart(rare, placed.withColumn("component", F.coalesce("component", "id"))), "bag-apart")
        pairs = found(rows.join(open_.select("id", "odd"), "id"), threshold)
        more = staged(checked(staged(pairs, "bag-pairs"), open_, threshold), "bag-links")
        if not more.isEmpty():
            joined, rows = staged(merged(joined, more, "a", "b"), "bag-components"), None
    named = joined.withColumnRenamed("node", "id").join(texts.select("id", "doc", "key"), "id")
    first = F.min(F.struct(F.col("doc").isNull(), "doc", "key"))
    chosen = named.groupBy("component").agg(first.alias("first"))
    chosen = named.select("id", "component").join(chosen, "component").select("id", "first")
    linked = F.col("first").isNotNull()
    return (
        texts.select("key", "id", "doc", "copies")
        .join(chosen, "id", "left")
        .select(
            "key",
            F.when(linked, F.col("first.doc")).otherwise(F.col("doc")).alias("class_id"),
            F.when(linked, F.col("first.key")).otherwise(F.col("key")).alias("survivor"),
            "copies",
        )
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings: float) -> DataFrame:
    """One row per row of ``docs``: row (its columns), class_id, survivor, kept.

    ``class_id`` is the smallest id of the class, null when no member has an id. ``survivor`` is the key of the one text
    that stands for the class and differs between classes; ``kept`` marks the rows with this text and this id.
    """
    found = classes(docs, doc_id, text, **settings)
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
        F.col(doc_id).cast("long").alias("id"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("key"),
    )
    kept = (F.col("key") == F.col("survivor")) & F.col("id").eqNullSafe(F.col("class_id"))
    return rows.join(found, "key").select("row", "class_id", "survivor", kept.alias("kept"))
