"""Spelling variants: words one edit apart, the common form each belongs to, and the root of its chain of forms.

Two words are one edit apart where their common prefix and suffix together reach the longer length less one. Such a pair
agrees, of four fixed pairs of prefix and suffix lengths that the longer length gives, in at least one, so words are
sorted by these keys and cut into tiles of a fixed size. Padded matrices of code points compare a tile with itself and,
where a key goes on, with each further tile that holds it; a pair counts only under the first key that it shares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattgrade.llm.common import numbered
from wattgrade.session import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]+"
TILE = 128
# Cells of one comparison of matrices, which bounds a task's memory whatever the length of the words.
CELLS = 1 << 22
KINDS = 4


def misspelt(word: Column, doc_id: Column, every: int) -> Column:
    """The word, without one code point where ``every`` divides the unsigned crc32 of ``<doc_id>:<word>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % every == 0, shorter).otherwise(word)


def word_counts(docs: DataFrame, min_length: int = 6, min_count: int = 5, every: int | None = None) -> DataFrame:
    """(word, n) of the runs of letters in all whole texts, A-Z lower-cased, of enough code points and occurrences.

    With ``every`` the query's misprints are put in first. Null texts hold no word; a null id counts as an empty one.
    Counts are combined in each task before they are shuffled, so a frequent word costs one row a task.
    """
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))
    words = docs.select("doc_id", F.explode(runs).alias("word")).where(F.length("word") >= min_length)
    if every:
        words = words.select(misspelt(F.col("word"), F.col("doc_id"), every).alias("word"))
        words = words.where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def ends(m: int | Column) -> list[tuple]:
    """(prefix, suffix) lengths, one of which any two words share that are one edit apart, the longer of m code points.

    The edit lies in one half of the longer word, so the other half is common; the same holds inside that half.
    """
    half = (lambda x: F.floor(x / 2).cast("int")) if isinstance(m, Column) else (lambda x: x // 2)
    front = half(m)
    back = m - front
    inner, outer = half(back), half(front)
    none = F.lit(0) if isinstance(m, Column) else 0
    return [(front + inner, none), (front, back - inner), (outer, back), (none, m - outer)]


def keyed(words: DataFrame) -> DataFrame:
    """Each word under the keys of both lengths that the longer word of a pair may have: its own and one more."""
    length = F.length("word")
    m = F.col("m")
    both = words.withColumn("m", F.explode(F.array(length, length + 1)))
    keys = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.xxhash64(m, F.lit(kind), F.substring("word", F.lit(1), a), F.substring("word", length - b + 1, b)).alias("key"),
        )
        for kind, (a, b) in enumerate(ends(m))
    ]
    return both.select("word", "n", "m", F.inline(F.array(*keys)))


def tiles_of(words: DataFrame, size: int) -> DataFrame:
    """(tile, low, high, words): the keyed words in order of length and key, cut into tiles; low and high are its
    first and last (m, key)."""
    placed = numbered(keyed(words), "spelling_place", F.col("m"), F.col("key"), F.col("word"))
    entry = F.struct("m", "key", "kind", "word", "n")
    tile = F.floor(F.col("spelling_place") / size).alias("tile")
    bounds = [f(F.struct("m", "key")).alias(name) for f, name in ((F.min, "low"), (F.max, "high"))]
    # At most ``size`` words, so the list is bounded.
    return staged(placed.groupBy(tile).agg(*bounds, F.collect_list(entry).alias("words")), "spelling-tiles")


def points(words: np.ndarray, width: int) -> np.ndarray:
    """Code points of each word, padded with zeros to the width."""
    return words.astype(f"U{width}").view(np.uint32).reshape(len(words), width)


def agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For all pairs of rows, the number of leading columns in which they agree."""
    differ = left[:, None, :] != right[None, :, :]
    return np.where(differ.any(axis=2), differ.argmax(axis=2), left.shape[1])


def near_pairs(a: dict[str, np.ndarray], b: dict[str, np.ndarray], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of the pairs one edit apart that share their key here and no earlier kind of key."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    step = len(a["word"])
    width = int(max(a["length"].max(), b["length"].max()))
    while step > 1 and step * step * width > CELLS:
        step = (step + 1) // 2
    for i in range(0, len(a["word"]), step):
        rows = slice(i, i + step)
        for j in range(i if same else 0, len(b["word"]), step):
            cols = slice(j, j + step)
            share = (a["key"][rows, None] == b["key"][None, cols]) & (a["m"][rows, None] == b["m"][None, cols])
            share &= a["kind"][rows, None] == b["kind"][None, cols]
            longest = np.maximum(a["length"][rows, None], b["length"][None, cols])
            share &= longest == a["m"][rows, None]  # else both words are the shorter kind here
            if same:
                share &= np.arange(i, i + share.shape[0])[:, None] < np.arange(j, j + share.shape[1])[None, :]
            # Only rows and columns that share a key with any other take part in the comparison.
            r, c = np.flatnonzero(share.any(axis=1)), np.flatnonzero(share.any(axis=0))
            if not len(r):
                continue
            x, y = a["word"][rows][r], b["word"][cols][c]
            prefix = agreement(points(x, width), points(y, width))
            suffix = agreement(points(reverse(x), width), points(reverse(y), width))
            m = longest[np.ix_(r, c)]
            near = share[np.ix_(r, c)] & (prefix < m) & (prefix + suffix >= m - 1)
            at, to = np.nonzero(near)
            first = first_kind(prefix[at, to], suffix[at, to], m[at, to])
            own = first == a["kind"][rows][r[at]]
            out.append((i + r[at[own]], j + c[to[own]]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def reverse(words: np.ndarray) -> np.ndarray:
    return np.array([w[::-1] for w in words.tolist()], object)


def first_kind(prefix: np.ndarray, suffix: np.ndarray, m: np.ndarray) -> np.ndarray:
    kind = np.full(len(m), KINDS)
    for k, (a, b) in reversed(list(enumerate(ends(m)))):
        kind[(prefix >= a) & (suffix >= b)] = k
    return kind


def columns(entries: list[dict]) -> dict[str, np.ndarray]:
    words = [e["word"] for e in entries]
    found = {c: np.array([e[c] for e in entries], np.int64) for c in ("m", "key", "kind", "n")}
    return found | {"word": np.array(words, object), "length": np.array([len(w) for w in words], np.int64)}


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, best_n, best) of the words of two tiles, as far as they are near one another."""
    for batch in batches:
        for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
            a = columns(left.as_py())
            same = not right.is_valid
            b = a if same else columns(right.as_py())
            i, j = near_pairs(a, b, same)
            if not len(i):
                continue
            names = sorted({*a["word"][i], *b["word"][j]})  # by code point, like the ties
            place = {name: at for at, name in enumerate(names)}
            first = np.array([place[w] for w in a["word"][i]])
            second = np.array([place[w] for w in b["word"][j]])
            word, other = np.concatenate([first, second]), np.concatenate([second, first])
            n = np.concatenate([b["n"][j], a["n"][i]])
            order = np.lexsort((other, -n, word))
            starts = np.flatnonzero(np.diff(word[order], prepend=-1))
            best, counts = order[starts], np.diff(np.append(starts, len(order)))
            spelt = [pa.array([names[at] for at in side[best]], pa.string()) for side in (word, other)]
            arrays = [spelt[0], pa.array(counts), pa.array(n[best]), spelt[1]]
            yield pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "best_n", "best"])


def nearest_forms(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best) of the words with a near word: how many, and the most frequent, ties to the
    smallest by code points."""
    tiles = tiles_of(words, tile)
    own = tiles.select(F.col("words").alias("left"), F.lit(None).cast(tiles.schema["words"].dataType).alias("right"))
    # A key that goes on beyond its tile: each pair of its tiles is a row of its own, dealt over all tasks.
    a, b = tiles.select("tile", "high").alias("a"), tiles.select("tile", "low").alias("b")
    met = a.join(b, F.col("a.high") == F.col("b.low")).where("a.tile < b.tile")
    met = met.select(F.col("a.tile").alias("x"), F.col("b.tile").alias("y"))
    wide = met.join(tiles.select(F.col("tile").alias("x"), F.col("words").alias("left")), "x")
    wide = wide.join(tiles.select(F.col("tile").alias("y"), F.col("words").alias("right")), "y")
    compared = own.unionByName(wide.select("left", "right"))
    found = compared.mapInArrow(summaries, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("rank"), F.col("best").alias("best")))
    grouped = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top"))
    return grouped.select("word", "n_near", (-F.col("top.rank")).alias("best_n"), F.col("top.best").alias("best"))


def group_variants(words: DataFrame, ratio: int = 5, tile: int = TILE) -> DataFrame:
    """Every word with its form, the root of its chain of forms, n, n_near and form_n.

    ``words`` holds (word, n) with distinct words. A word's form is its near word of largest n (ties: the smallest by
    code points) if that is at least ``ratio`` times its own, else null. n grows along a chain of forms, so chains end;
    each round doubles the part that is followed. Words of any length are compared; an empty table gives no rows; null
    words have no form and no near word. No list is longer than a tile, and no word is compared with all others.
    """
    words = staged(words.select("word", "n"), "spelling-words")
    near = nearest_forms(words.where("word is not null"), tile)
    form = F.when(F.col("best_n") >= F.col("n") * ratio, F.col("best"))
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        form.alias("form"),
        F.when(form.isNotNull(), F.col("best_n")).alias("form_n"),
    )
    found = staged(found, "spelling-forms")
    roots = staged(found.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        moved = staged(moved, "spelling-roots")
        if not moved.where("next is not null").limit(1).count():
            break
        roots = moved.drop("next")
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
