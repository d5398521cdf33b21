"""Ranked lexical search over an index that is stratified by document length.

Documents with the same normaliser m form a stratum; in it, the postings of a term are ordered by tf, so what a term
adds to a score is computed once for each tf. The largest tf of each term bounds the score of a stratum for an item;
strata are visited from the largest bound down and no further than the worst of the best documents found.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from wattgrade.session import staged

# The signs between terms, and the only letters that are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Every byte outside a term becomes a space; bytes above 0x7F belong to terms, as their code points do.
FOLD = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256)).lower()
# Terms of one block of items, and postings of one segment of the index: both are held by a task.
BLOCK_TERMS = 100_000
SEGMENT = 2_000_000


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), once each. Null texts have no term."""
    found = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select("item_id", F.explode(found).alias("term")).distinct()


def blocks_of_items(asked: DataFrame, block_terms: int) -> DataFrame:
    """item_id, its terms and the number of its block; a block holds about ``block_terms`` terms, with repeats."""
    whole = asked.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    before = Window.orderBy("item_id").rowsBetween(Window.unboundedPreceding, -1)
    # One row per item; a query set too large for one task's sort would be searched in several calls.
    size = F.coalesce(F.sum(F.size("terms").cast("long")).over(before), F.lit(0))
    return whole.withColumn("block", F.floor(size / block_terms))


def postings(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document: all its terms counted, those asked for as places in ``terms``."""
    schema = (
        T.StructType()
        .add("doc_id", docs.schema["doc_id"].dataType)
        .add("n", T.LongType())
        .add("terms", T.ArrayType(T.IntegerType(), False))
        .add("tfs", T.ArrayType(T.IntegerType(), False))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t.encode(): at for at, t in enumerate(terms)}
        for batch in batches:
            n, at, tf, ends = [], [], [], [0]
            for text in batch.column("text"):
                found = terms_of(text.as_py())
                n.append(len(found))
                counts = Counter(found)
                kept = counts.keys() & place.keys()
                at.extend([place[t] for t in kept])
                tf.extend([counts[t] for t in kept])
                ends.append(len(at))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (at, tf)]
            arrays = [batch.column("doc_id"), pa.array(n, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(count, schema)


class Items:
    """The items of a block: their terms, one after the other, and where each begins."""

    def __init__(self, ids: pa.Array, terms: list[np.ndarray], weights: np.ndarray) -> None:
        self.ids, self.weights = ids, weights
        self.terms = np.concatenate(terms)
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in terms])])

    def of(self, item: int) -> np.ndarray:
        return self.terms[self.starts[item] : self.starts[item + 1]]


class Stratum:
    """Postings of the documents of one m, by term and then tf."""

    def __init__(self, m: int, docs: np.ndarray, owner: np.ndarray, terms: np.ndarray, tfs: np.ndarray, items: Items):
        order = np.lexsort((tfs, terms))
        self.docs, self.owner = docs, owner[order]
        terms, tfs = terms[order], tfs[order]
        levels, level = np.unique(tfs, return_inverse=True)
        impact = (1_000_000_000 * levels) // (1000 * levels + 20 * m)  # once for each tf
        self.values = impact[level]
        self.known, first = np.unique(terms, return_index=True)
        self.first = np.append(first, len(terms))
        best = np.zeros(len(items.weights), np.int64)
        best[self.known] = self.values[self.first[1:] - 1] * items.weights[self.known]  # tf grows within a term
        self.bounds = np.add.reduceat(best[items.terms], items.starts[:-1])

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Score of every document of the stratum, in whole numbers."""
        out = np.zeros(len(self.docs), np.int64)
        at = np.searchsorted(self.known, terms)
        for term, place in zip(terms, at, strict=True):
            if place < len(self.known) and self.known[place] == term:
                span = slice(self.first[place], self.first[place + 1])
                out[self.owner[span]] += self.values[span] * weights[term]  # a document holds a term once
        return out


class Best:
    """The k best documents of an item so far: score first, then the order of the ids."""

    def __init__(self, k: int) -> None:
        self.k, self.floor = k, 1
        self.scores = np.zeros(0, np.int64)
        self.rank = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, rank: np.ndarray) -> None:
        kept = scores >= self.floor
        scores, rank = np.concatenate([self.scores, scores[kept]]), np.concatenate([self.rank, rank[kept]])
        order = np.lexsort((rank, -scores))[: self.k]
        self.scores, self.rank = scores[order], rank[order]
        if len(order) == self.k:
            self.floor = int(self.scores[-1])


def search_segment(batch: pa.Table, items: Items, k: int, floors: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The k best documents of a segment for every item, without those below the item's floor, which it raises."""
    m = batch.column("m").to_numpy()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy())])
    terms = pc.list_flatten(batch.column("terms")).to_numpy().astype(np.int64)
    tfs = pc.list_flatten(batch.column("tfs")).to_numpy().astype(np.int64)
    in_order = pc.sort_indices(batch.column("doc_id"), null_placement="at_end").to_numpy()
    rank = np.empty(len(m), np.int64)
    rank[in_order] = np.arange(len(m))
    strata = []
    order = np.argsort(m, kind="stable")
    for docs in np.split(order, np.flatnonzero(np.diff(m[order])) + 1):
        sizes = ends[docs + 1] - ends[docs]
        owner = np.repeat(np.arange(len(docs)), sizes)
        if len(owner):
            at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(ends[docs], sizes)
            strata.append(Stratum(int(m[docs[0]]), docs, owner, terms[at], tfs[at], items))
    if not strata:
        return
    bounds = np.stack([s.bounds for s in strata])
    visits = np.argsort(-bounds, axis=0, kind="stable")
    for item in range(len(items.ids)):
        best, asked = Best(k), items.of(item)
        best.floor = max(1, int(floors[item]))
        for at in visits[:, item]:
            if bounds[at, item] < best.floor:  # no later stratum can reach it either
                break
            best.add(strata[at].scores(asked, items.weights), rank[strata[at].docs])
        floors[item] = max(floors[item], best.floor)
        if len(best.scores):
            ids = batch.column("doc_id").take(pa.array(in_order[best.rank])).combine_chunks()
            item_id = pa.repeat(items.ids[item], len(ids))
            yield pa.RecordBatch.from_arrays([item_id, ids, pa.array(best.scores)], ["item_id", "doc_id", "score"])


def search_block(index: DataFrame, items: Items, k: int, segment: int, item_type: T.DataType) -> DataFrame:
    """(item_id, doc_id, score): the best documents of each task, with every one of the k best of all among them."""
    schema = (
        T.StructType()
        .add("item_id", item_type)
        .add("doc_id", index.schema["doc_id"].dataType)
        .add("score", T.LongType())
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        floors = np.zeros(len(items.ids), np.int64)
        for batch in batches:
            held.append(batch)
            size += len(batch.column("terms").flatten()) + batch.num_rows
            if size >= segment:
                yield from search_segment(pa.Table.from_batches(held), items, k, floors)
                held, size = [], 0
        if held:
            yield from search_segment(pa.Table.from_batches(held), items, k, floors)

    return index.mapInArrow(search, schema)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS, segment: int = SEGMENT
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k highest-scoring rows of ``docs`` with a score above 0.

    ``docs`` holds doc_id and text, ``items`` item_id and text; other columns are ignored, whatever their names. Equal
    scores go by ascending doc_id, null ids last; rows that repeat an id each count. Null and empty texts, texts without
    terms and items without terms give no rows; rows of ``items`` with the same id are one item. Texts of any length are
    counted whole. Empty tables give no rows.

    Items are taken in blocks of about ``block_terms`` terms, whose statistics the driver and each task hold; the
    documents are read once for each block. A task indexes segments of about ``segment`` postings.
    """
    spark = docs.sparkSession
    asked = staged(blocks_of_items(item_terms(items.select("item_id", "text")), block_terms), "search-items")
    blocks = [r["block"] for r in asked.select("block").distinct().orderBy("block").collect()]
    item_type, id_type = asked.schema["item_id"].dataType, docs.schema["doc_id"].dataType
    found = None
    for block in blocks:
        listed = asked.where(F.col("block") == block).select("item_id", "terms").orderBy("item_id").collect()
        terms = sorted({t for r in listed for t in r["terms"]})
        place = {t: at for at, t in enumerate(terms)}
        counted = staged(postings(docs, terms), "search-postings")
        totals = counted.agg(F.count_if(F.col("n") > 0).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
        # One row for each term of the block.
        held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        ratio = F.lit(2.0 * totals["N"] + 2) / (2 * F.col("df") + 1).cast("double")
        weight = F.floor(1000 * F.log(ratio)).cast("long").alias("w")
        weights = np.zeros(len(terms), np.int64)
        for r in held.select("term", weight).collect():
            weights[r["term"]] = r["w"]
        at = [np.array([place[t] for t in r["terms"]], np.int64) for r in listed]
        asked_items = Items(pa.array([r["item_id"] for r in listed], to_arrow_type(item_type)), at, weights)
        m = F.lit(50) + F.expr(f"(50 * n * {totals['N']}L) div {max(1, totals['L'])}L")
        # By length, so that strata are large; the hash splits a length that many documents share.
        index = counted.where("size(terms) > 0").withColumn("m", m)
        index = index.repartitionByRange(F.col("m"), F.xxhash64("doc_id", "n", "terms", "tfs"))
        part = search_block(index, asked_items, k, segment, item_type)
        found = part if found is None else found.unionByName(part)
    if found is None:
        schema = T.StructType().add("item_id", item_type).add("doc_id", id_type).add("score", T.LongType())
        found = spark.createDataFrame([], schema)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
