import math
import random
import re
from collections import Counter

import pytest

from wattgrade.llm import lexical_search
from wattgrade.llm.common import table

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWERED = str.maketrans(lexical_search.UPPER, lexical_search.LOWER)


def words(text):
    return TERM.findall((text or "").translate(LOWERED))


def plain_search(docs, items, k):
    """Every document scored for every item, one by one."""
    counts = [(doc_id, Counter(words(text))) for doc_id, text in docs]
    counts = [(doc_id, c, c.total()) for doc_id, c in counts if c]
    N, L = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(words(text))
    out = set()
    for item_id, terms in asked.items():
        scored = []
        for doc_id, c, n in counts:
            m = 50 + (50 * n * N) // L
            score = sum(
                math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms
                if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1):
            out.add((item_id, rank, doc_id, -score))
    return out


def found(spark, docs, items, k=50, **sizes):
    docs = spark.createDataFrame(docs, "doc_id long, text string, n long, terms string")
    rows = lexical_search.search(docs, spark.createDataFrame(items, "item_id long, text string"), k, **sizes).collect()
    got = [tuple(r) for r in rows]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("sizes", [{}, {"block_terms": 40, "segment": 300}])
def test_equals_brute_force_on_the_table(spark, sizes):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    items = table(spark, SF, "benchmark")
    if sizes:  # small blocks read the documents once each
        items = items.where("item_id < 6")
    got = [tuple(r) for r in lexical_search.search(docs, items, 50, **sizes).collect()]
    want = plain_search([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()], 50)
    assert len(got) == len(want) and set(got) == want


def test_small_vocabulary_with_many_ties(spark):
    draw = random.Random(3)
    docs = [(i % 90, " ".join(draw.choices("abcdefg", k=draw.choice([1, 2, 2, 2, 30]))), 0, "x") for i in range(400)]
    items = [(i, " ".join(draw.choices("abcdefgh", k=4))) for i in range(12)]
    assert found(spark, docs, items, k=7, segment=60) == plain_search([d[:2] for d in docs], items, 7)


def test_defined_results_of_unusual_rows(spark):
    docs = [
        (1, None, 0, ""),
        (2, "", 0, ""),
        (3, " ?! {}", 0, ""),
        (4, "Été ÉTÉ été-3x 日本", 0, ""),
        (None, "été", 0, ""),
        (5, "ship " * 100000 + "north", 0, ""),
        (6, "north ship", 0, ""),
        (7, "ship", 0, ""),
    ]
    items = [(1, "été!"), (2, "Ship, NORTH ship"), (2, "日本"), (3, None), (4, "--"), (None, "3X"), (5, "absent")]
    got = found(spark, docs, items)
    assert got == plain_search([d[:2] for d in docs], items, 50)
    assert {r[0] for r in got} == {1, 2, None}
    assert {(1, 1, 4), (1, 2, None)} <= {r[:3] for r in got}  # equal scores: null ids last


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == set()
    assert found(spark, [(1, "a", 0, "")], []) == set()


def test_bounds_skip_strata(monkeypatch):
    """The strata left out hold no document that could be among the best: their bounds are below the floor."""
    import numpy as np
    import pyarrow as pa

    visited = []
    real = lexical_search.Stratum.scores
    monkeypatch.setattr(lexical_search.Stratum, "scores", lambda s, *a: visited.append(s.bounds[0]) or real(s, *a))
    rows = 3000
    index = pa.table(
        {
            "doc_id": pa.array(range(rows)),
            "m": pa.array([50 + i % 40 for i in range(rows)], pa.int64()),
            "terms": pa.array([[0, 1] if i % 40 == 0 else [1] for i in range(rows)], pa.list_(pa.int32())),
            "tfs": pa.array([[2, 1] if i % 40 == 0 else [1] for i in range(rows)], pa.list_(pa.int32())),
        }
    )
    items = lexical_search.Items(pa.array([9]), [np.array([0, 1])], np.array([5000, 10]))
    out = list(lexical_search.search_segment(index, items, 20, np.zeros(1, np.int64)))
    assert out[0].column("doc_id").to_pylist() == [40 * i for i in range(20)]
    assert len(visited) == 1
