import math

import numpy as np
from pyspark.sql import functions as F

from wattgrade.llm import embedding_dedup, nearest
from wattgrade.session import staged_parts

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN = float("nan")


def clustered(n, d=16, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(n // 8, d))
    x = centers[rng.integers(0, len(centers), n)] + rng.normal(scale=0.22, size=(n, d))
    return (x * rng.uniform(0.1, 9.0, size=(n, 1))).astype(np.float32)


def brute_links(x, threshold):
    u = x.astype(np.float64)
    u /= np.sqrt((u * u).sum(axis=1))[:, None]
    s = u @ u.T
    np.fill_diagonal(s, -1.0)
    assert (np.abs(s - threshold) > 1e-9).all()  # no pair so near to the threshold that rounding decides
    return s >= threshold


def brute_components(links):
    label = list(range(len(links)))
    changed = True
    while changed:
        changed = False
        for i, j in zip(*np.nonzero(links), strict=True):
            if label[j] < label[i]:
                label[i], changed = label[j], True
    return label


def test_near_duplicates_match_brute_force(spark):
    x = clustered(400)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    for tile in (64, 4096):
        got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, tile_rows=tile, cuts=(4, 9)).collect()}
        links = brute_links(x, 0.9)
        label = brute_components(links)
        assert links.sum() > 300
        assert {i: got[i]["n_links"] for i in got} == {i: int(links[i].sum()) for i in range(len(x))}
        assert {i: got[i]["component_id"] for i in got} == dict(enumerate(label))
        assert all(got[i]["kept"] == (label[i] == i) for i in got)


def test_near_duplicates_edge_rows(spark, rows_of):
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [0.0, 1e-30], 0), (4, [0.0, 3e30], 0), (5, None, 0),
        (6, [0.0, 0.0], 0), (7, [1.0, NAN], 0), (8, [math.inf, 0.0], 0), (9, [1.0, None], 0), (10, [], 0), (11, [1.0], 0),
        (None, [1.0, 0.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"component_id": F.lit("x"), "id": F.lit(1), "n_links": F.lit(None)})
    got = rows_of(embedding_dedup.near_duplicates(df))
    alone = [(i, 0, i, True) for i in (5, 6, 7, 8, 9, 10, 11)]
    linked = [(1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False)]
    assert got == sorted([*alone, *linked, (None, 0, None, True)], key=repr)
    two = spark.createDataFrame([(i, [1.0 + i, 1.0, 9.0], 0) for i in range(20)] + [(30, [1.0, 1.0], 0), (31, [2.0, 2.0], 0)], SCHEMA)
    found = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(two).collect()}
    assert (found[31]["n_links"], found[31]["component_id"], found[0]["n_links"] > 0) == (1, 30, True)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    assert embedding_dedup.near_duplicates(df.where("vec_id = 5")).collect()[0]["kept"]


def test_close_pairs_stop_early_but_lose_nothing():
    x, axes = clustered(300, 32, 5).astype(np.float64), np.linalg.qr(np.random.default_rng(1).normal(size=(32, 32)))[0]
    links = brute_links(x, 0.9)
    i, j = embedding_dedup.close_pairs(x, x, axes, 0.9, (8, 16), strip=50)
    found = np.zeros_like(links)
    found[i[i != j], j[i != j]] = True
    assert (found == links).all()


def test_few_true_finds_what_is_true():
    rng = np.random.default_rng(2)
    for shape, share in (((7, 9), 0.1), ((3, 8), 1.0), ((5, 5), 0.0), ((0, 4), 0.0)):
        found = rng.random(shape) < share
        assert (embedding_dedup.few_true(found) == np.flatnonzero(found)).all()


def test_tiles_are_compared_without_a_shuffle(spark, monkeypatch):
    x, plans = clustered(1500, seed=5), []

    def planned(spark, parts, purpose):
        def each():
            for part in parts:
                plans.append(part._jdf.queryExecution().executedPlan().toString())
                yield part

        return staged_parts(spark, each(), purpose)

    monkeypatch.setattr(embedding_dedup, "staged_parts", planned)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(df, tile_rows=64, group_bytes=1 << 16).collect()}
    assert got == {i: int(n) for i, n in enumerate(brute_links(x, 0.9).sum(axis=1))}
    assert len(plans) > 2 and not any("Exchange" in p for p in plans)


def test_smallest_reachable_on_a_chain():
    i = np.arange(999)
    assert (embedding_dedup.smallest_reachable(1000, i[::-1], i[::-1] + 1) == 0).all()


def brute_search(x, ids, queries, k):
    out = {}
    for q in queries:
        at = int(np.flatnonzero(ids == q)[0])
        score = (x.astype(np.float64) * x[at].astype(np.float64)).sum(axis=1)
        out[int(q)] = sorted(((-s, int(i)) for s, i in zip(score, ids, strict=True) if i != q))[:k]
    return out


def test_search_matches_brute_force_with_ties(spark):
    x = clustered(300)
    x[100:140] = x[100]  # ties
    ids = np.arange(300)
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)], SCHEMA)
    got = nearest.search(df, F.col("id") % 20 == 0, k=20, query_rows=6, block_rows=64, blocks_per_task=2).collect()
    want = brute_search(x, ids, ids[ids % 20 == 0], 20)
    for q, best in want.items():
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[1] for m in mine] == [b[1] for b in best]
        assert np.allclose([m[2] for m in mine], [-b[0] for b in best], rtol=1e-12)
    assert len(got) == 20 * len(want)


def test_search_edge_rows(spark, rows_of):
    rows = [(0, [1.0, 0.0], 0), (20, None, 0), (40, [0.0, 0.0], 0), (None, [9.0, 9.0], 0), (5, [NAN, 1.0], 0),
            (7, [2.0, 0.0], 0), (7, [2.0, 0.0], 0), (8, [-1.0, 5.0], 0), (60, [1.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("block", F.lit("b"))
    is_query = F.col("id") % 20 == 0
    assert rows_of(nearest.search(df, is_query)) == [(0, 1, 7, 2.0), (0, 2, 8, -1.0)]
    assert rows_of(nearest.search(df.unionByName(df.where("vec_id = 60").withColumn("vec_id", F.lit(61).cast("long"))), is_query)) == [
        (0, 1, 7, 2.0), (0, 2, 8, -1.0), (60, 1, 61, 1.0)
    ]
    assert nearest.search(df.where("vec_id = 7"), is_query).count() == 0
    assert nearest.search(df.limit(0), is_query).count() == 0


def test_quantised_products_stay_within_their_bounds():
    x = clustered(200, 48, 9).astype(np.float64)
    q, scale, norm, error = nearest.quantised(x)
    near = nearest.products(q, q) * scale[:, None] * scale[None, :]
    slack = error[:, None] * norm[None, :] + (norm + error)[:, None] * error[None, :]
    assert (np.abs(near - x @ x.T) <= slack + 1e-9).all()


def test_vectors_of_one_id_take_one_place(spark):
    draw = np.random.default_rng(8)
    rows = [(0, draw.normal(size=4).tolist(), 0)] + [(7, (draw.normal(size=4) + 9).tolist(), 0) for _ in range(40)]
    rows += [(100 + i, draw.normal(size=4).tolist(), 0) for i in range(36)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for block in (8, 4096):
        got = nearest.search(df, F.col("id") == 0, k=20, block_rows=block).collect()
        best = {}
        for i, v, _ in rows[1:]:
            best[i] = max(best.get(i, -math.inf), float(np.dot(rows[0][1], v)))
        want = sorted(best, key=lambda i: (-best[i], i))[:20]
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == want
