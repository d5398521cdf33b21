import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from wattgrade.llm import spelling
from wattgrade.llm.common import table
from wattgrade.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWERED = str.maketrans(spelling.UPPER, spelling.LOWER)


def plain_words(docs, every):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWERED)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def edits(word, alphabet):
    """All words one edit away."""
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in alphabet)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in alphabet)


def plain_groups(counts, ratio=5):
    alphabet = sorted(set("".join(counts)))
    forms, rows = {}, []
    for word, n in counts.items():
        near = {e for e in edits(word, alphabet) if e != word and e in counts}
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= ratio * n else None
        rows.append((word, n, len(near)))
    out = set()
    for word, n, n_near in rows:
        root = word
        while forms[root]:
            root = forms[root]
        form = forms[word]
        out.add((word, form, root, n, n_near, counts[form] if form else None))
    return out


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    want = plain_groups(plain_words(docs, 199))
    got = [tuple(r) for r in QUERIES["op12_spelling_variants"](spark, SF).collect()]
    assert len(got) == len(want) and set(got) == want
    assert any(form for _, form, *_ in want)


@pytest.mark.parametrize("tile", [2, 7, 128])
def test_tiles_of_any_size_find_every_pair_once(spark, tile):
    draw = random.Random(tile)
    words = {"".join(draw.choices("abé", k=draw.randint(3, 8))): draw.randint(1, 400) for _ in range(250)}
    words |= {"abcabc" + c: draw.randint(1, 9) for c in "defghijklmnopqrs"}  # one key that fills several tiles
    got = spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long"), tile=tile)
    got = [tuple(r) for r in got.collect()]
    want = plain_groups(words)
    assert len(got) == len(want) and set(got) == want


def test_ends_cover_every_edit():
    for m in range(3, 40):
        for p in range(m):
            for s in range(m - 1 - p, m):
                assert spelling.first_kind(np.array([p]), np.array([s]), np.array([m]))[0] < spelling.KINDS


def test_chains_ties_and_unusual_rows(spark):
    rows = [("chain1", 1), ("chain12", 5), ("chain123", 25), ("chain1234", 125), (None, 3)]
    rows += [("tiebreak", 1), ("tiebreal", 9), ("tiebreaj", 9), ("x" * 20000, 2), ("x" * 20001, 10)]
    found = spelling.group_variants(spark.createDataFrame(rows, "word string, n long"))
    got = {r["word"]: (r["form"], r["root"], r["n_near"], r["form_n"]) for r in found.collect()}
    assert got["chain1"] == ("chain12", "chain1234", 1, 5)
    assert got["chain1234"] == (None, "chain1234", 1, None)
    assert got["tiebreak"] == ("tiebreaj", "tiebreaj", 2, 9)
    assert got["x" * 20000] == ("x" * 20001, "x" * 20001, 1, 10)
    assert got[None] == (None, None, 0, None)


def test_words_of_unusual_texts(spark):
    text = "Wörter WÖRTER straße× ab12cdefgh " + "longest" * 30000
    rows = [(1, text, 0), (1, text, 0), (None, text, 0), (2, None, 0), (3, "", 0), (4, "?!", 0)] + [(5, "Wörter", 0)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, word long")
    got = {r["word"]: r["n"] for r in spelling.word_counts(docs, min_count=1).collect()}
    assert got == {"wörter": 5, "wÖrter": 3, "straße×": 3, "cdefgh": 3, "longest" * 30000: 3}
    assert spelling.group_variants(spelling.word_counts(docs.limit(0))).count() == 0
    assert plain_words([r[:2] for r in rows * 5], 2) == {
        r["word"]: r["n"] for r in spelling.word_counts(spark.createDataFrame(rows * 5, docs.schema), every=2).collect()
    }
