import gc
import hashlib
import random
import re
import time
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from wattgrade.llm import bag_minhash, language_id, queries, sentencepiece_bpe, suffix_dedup, toxicity
from wattgrade.session import drop_unread, shared_root, staged

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(1, 9))) for _ in range(n))


# --- BagMinHash


def brute_bag(text, words):
    tokens = text.split()
    grams = [tuple(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or ([tuple(tokens)] if tokens else [])
    bag = {}
    for g in grams:
        bag[g] = bag.get(g, 0) + 1
    return bag


def brute_similarity(a, b):
    common = sum(min(n, b.get(g, 0)) for g, n in a.items())
    union = sum(a.values()) + sum(b.values()) - common
    return common / union if union else 0.0


def brute_classes(docs):
    """Smallest id of each id's class: equal texts, and components of similar ones."""
    bags = {i: brute_bag(t or "", 5) for i, t in docs}
    texts = {i: t or "" for i, t in docs}
    label = {i: i for i, _ in docs}
    ids = list(label)
    links = [
        (x, y) for n, x in enumerate(ids) for y in ids[:n]
        if texts[x] == texts[y] or (0.8 * max(sum(bags[x].values()), 1) <= sum(bags[y].values()) * 1.0001
                                    and brute_similarity(bags[x], bags[y]) >= 0.8)
    ]
    changed = True
    while changed:
        changed = False
        for x, y in links:
            low = min(label[x], label[y])
            changed |= label[x] != low or label[y] != low
            label[x] = label[y] = low
    return label


def copies(rng, text, changes):
    tokens = text.split()
    for at in rng.sample(range(len(tokens)), changes):
        tokens[at] = "changed" + str(rng.randint(0, 99))
    return " ".join(tokens)


def test_classes_match_brute_force(spark):
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(1, 160)) for _ in range(60)]
    base = prose(rng, 150)
    texts += [copies(rng, base, rng.randint(1, 4)) for _ in range(50)]
    chain = prose(rng, 200)
    for _ in range(12):  # each near its neighbour, the ends far apart
        texts.append(chain)
        chain = copies(rng, chain, 3)
    texts += [texts[3]] * 20 + ["short text", "short text", "short  text", "", "", None, "a b a b a b a b a b", "a b a b a b a b a b a b"]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"id": F.lit(1), "key": F.lit("k"), "bands": F.lit(0)})
    got = bag_minhash.near_duplicates(df).select("row.*", "class_id", "kept").collect()
    want = brute_classes(docs)
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got) and len(got) == len(docs)
    assert len(set(want.values())) < 90


def test_hot_bands_of_texts_below_the_threshold(spark):
    rng = random.Random(9)
    base, second = prose(rng, 300), prose(rng, 300)
    texts = [copies(rng, base, rng.randint(1, 14)) for _ in range(160)] + [copies(rng, second, 6) for _ in range(60)]
    mixed = copies(rng, second, 8)  # too far from the original, near to each other
    texts += [copies(rng, mixed, 2) for _ in range(40)]
    texts += [" ".join(["again and"] * rng.randint(40, 90)) for _ in range(30)] + [prose(rng, 20000)] * 2
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    want = brute_classes([d for d in docs if len(d[1]) < 50_000])
    got = bag_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["row"]["doc_id"]: r["class_id"] for r in got} == want | {len(docs) - 2: len(docs) - 2, len(docs) - 1: len(docs) - 2}
    assert 10 < len(set(want.values())) < 250


def test_only_pairs_that_may_reach_the_threshold_are_compared(spark):
    """Many texts that share nine tenths of their shingles with one, and less than eight tenths with each other."""
    rng = random.Random(10)
    rows = [(i, [*range(170), *(1000 * i + j for j in range(30))]) for i in range(1, 301)] + [(301, [*range(165), *range(1000, 1035)])]
    bodies = spark.createDataFrame([(i, rng.sample(g, len(g))) for i, g in rows], "id long, grams array<long>")
    rare = bag_minhash.rare_grams(bodies, 0.8).withColumn("component", F.col("id"))
    want = {(a, b) for a, x in rows for b, y in rows[a:] if len({*x} & {*y}) * 1.8 >= 0.8 * (len(x) + len(y)) - 1e-9}
    met = {tuple(r) for r in bag_minhash.gram_pairs(rare, 0.8).collect()}
    assert want == {(1, 301)} <= met and len(met) < 10


def test_hot_shingles_of_unlike_texts(spark):
    """Texts that have most of their shingles in common with all others, and less than eight tenths."""
    rng = random.Random(13)
    rows = [(i, rng.sample(range(200), 150)) for i in range(1, 201)]
    rows += [(201 + i, [*rows[i][1][:-4], *range(1000 + 4 * i, 1004 + 4 * i)]) for i in range(3)]
    hashed = {g: rng.getrandbits(63) for _, grams in rows for g in grams}
    grams = [np.array([hashed[g] for g in held], np.int64) for _, held in rows]
    odd = bag_minhash.parities(np.repeat(np.arange(len(rows)), [len(g) for g in grams]), np.concatenate(grams), len(rows))
    held = [(i, g.tolist(), o.tolist(), i) for (i, _), g, o in zip(rows, grams, odd, strict=True)]
    bodies = spark.createDataFrame(held, "id long, grams array<long>, odd array<long>, component long")
    rare = bag_minhash.rare_grams(bodies, 0.8).join(bodies.select("id", "odd", "component"), "id")
    want = {(a, b) for a, x in rows for b, y in rows[a:] if len({*x} & {*y}) * 1.8 >= 0.8 * (len(x) + len(y)) - 1e-9}
    met = {tuple(r) for r in bag_minhash.gram_pairs(rare, 0.8).collect()}
    assert {(1, 201), (2, 202), (3, 203)} <= want <= met and len(met) < 100


def test_texts_of_a_hot_shingle_meet_in_groups_first(spark):
    rows = spark.range(3000).selectExpr("id", "100 as n", "7L as gram", "0 as at", "id as component")
    met = bag_minhash.gram_groups(rows, 0.8).collect()
    assert 1000 < len(met) < 3000 * bag_minhash.MEETING


def test_no_query_of_the_classes_joins_many_tables(spark, monkeypatch):
    """Each join of a small table is a broadcast that the driver holds, all those of one query at the same time."""
    joins = {}

    def counted(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins[name] = max(joins.get(name, 0), len(re.findall(r"^\W*Join ", plan, re.M)))
        return staged(df, name)

    monkeypatch.setattr(bag_minhash, "staged", counted)
    rng = random.Random(3)
    base = prose(rng, 120)
    docs = [(i, copies(rng, base, rng.randint(1, 9))) for i in range(40)]
    got = bag_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["row"]["doc_id"]: r["class_id"] for r in got} == brute_classes(docs)
    assert {"bag-pairs", "bag-links"} <= {*joins} and max(joins.values()) <= 7


def test_grams_of_one_component_are_left_out(spark):
    rare = spark.createDataFrame([(i, 9, g, 0) for i, g in [(1, 5), (2, 5), (3, 5), (1, 6), (4, 6), (4, 7)]], "id long, n int, gram long, at int")
    placed = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "id long, component long")
    got = sorted((r["id"], r["gram"], r["component"]) for r in bag_minhash.apart(rare, placed).collect())
    assert got == [(1, 6, 1), (4, 6, 4)]


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(2)
    errors = []
    for n in range(30):
        tokens = [f"w{n}-{rng.randint(0, 40)}" for _ in range(120)]
        other = [t if rng.random() < 0.8 else "z" + t for t in tokens]
        a, b = " ".join(tokens).encode(), " ".join(other).encode()
        sign = bag_minhash.signatures(*bag_minhash.bags([a, b], 1), 2, 600) & np.uint64(0xFFFFFFFF)
        truth = brute_similarity(brute_bag(a.decode(), 1), brute_bag(b.decode(), 1))
        errors.append((sign[0] == sign[1]).mean() - truth)
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.05


def test_classes_of_odd_rows(spark, rows_of):
    df = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (None, "z"), (7, None), (7, None)], "doc_id long, text string")
    got = rows_of(bag_minhash.near_duplicates(df).select("row.doc_id", "class_id", "kept"))
    assert got == sorted([(None, 4, False), (4, 4, True), (None, None, True), (7, 7, True), (7, 7, True)], key=repr)
    assert bag_minhash.near_duplicates(df.limit(0)).count() == 0


def test_classes_with_null_and_shared_ids(spark):
    rng = random.Random(6)
    near, pair, same, apart = (prose(rng, 100) for _ in range(4))
    lone, other = prose(rng, 80), prose(rng, 90)
    near_copy, pair_copy = copies(rng, near, 1), copies(rng, pair, 1)
    rows = [(5, near), (None, near_copy), (None, lone), (None, pair), (None, pair_copy), (8, same), (8, apart), (None, other), (None, other)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    got = bag_minhash.near_duplicates(df).collect()
    by_text = {r["row"]["text"]: (r["class_id"], r["kept"]) for r in got}
    assert len(got) == len(rows) and by_text[near] == (5, True) and by_text[near_copy] == (5, False)
    assert by_text[lone] == by_text[other] == (None, True) and by_text[same] == by_text[apart] == (8, True)
    assert sorted([by_text[pair], by_text[pair_copy]]) == [(None, False), (None, True)]
    left = [r["text"] for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()]
    assert sorted(left) == sorted([near, lone, other, same, apart, min(pair, pair_copy, key=lambda t: hashlib.md5(t.encode()).hexdigest())])


def test_queries_match_brute_force_on_a_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r["doc_id"]: r["class_id"] for r in queries.op4_minhash_near_dedup(spark, SMALL).collect()}
    assert got == brute_classes(docs)
    removed = {r["doc_id"]: tuple(r)[1:] for r in queries.op8_suffix_dedup(spark, SMALL).collect()}
    assert removed == brute_repeats(docs, 50)


# --- Repeated byte strings


def brute_repeats(docs, length):
    first = {}
    for i, t in docs:
        data = (t or "").encode()
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if i is not None:
                first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in docs:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if i is not None and first[data[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def digest(df, length=50):
    found = suffix_dedup.remove_repeats(df, length=length)
    return found.select("row.doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256))


def test_repeats_match_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    shared = [prose(rng, 20) for _ in range(6)]
    docs = []
    for i in range(120):
        parts = [prose(rng, rng.randint(0, 12)) for _ in range(3)]
        body = parts[0] + rng.choice(shared)[rng.randint(0, 30) :] + parts[1] + rng.choice(shared)[: rng.randint(40, 110)] + parts[2]
        docs.append((i * 3, body))
    docs += [(1000, "ab" * 400), (1001, "ab" * 300 + "c"), (1002, "x" * 500), (1003, "x" * 49), (1004, "x" * 50), (1005, ""), (1006, None)]
    docs += [(1007, "é" * 60 + "\0tail" * 20), (1008, "é" * 60 + "\0tail" * 20), (2, docs[5][1]), (900, docs[5][1])]
    rng.shuffle(docs)
    want = brute_repeats(docs, 50)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"kept": F.lit(1), "_0": F.lit("x"), "row": F.lit(2)})
    for parts in (1, 7):
        got = {r[0]: tuple(r)[1:] for r in digest(df.repartition(parts)).collect()}
        assert got == want
    monkeypatch.setattr(suffix_dedup, "COMMON_CHUNKS", 2)  # windows dealt one by one
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4096)
    assert {r[0]: tuple(r)[1:] for r in digest(df.repartition(7)).collect()} == want
    rows = suffix_dedup.remove_repeats(df).select("row.*").columns
    assert rows == ["doc_id", "kept", "_0", "row"]


def test_repeats_of_odd_rows(spark, rows_of):
    text = "the same passage of more than fifty bytes stands in every one of these rows"
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (9, text)], "doc_id long, text string")
    assert [(r[0], r[2]) for r in rows_of(digest(df))] == sorted([(5, 0), (5, 0), (9, len(text)), (None, 0)], key=repr)
    assert digest(df.limit(0)).count() == 0


def test_index_finds_the_earliest_owner():
    rng = random.Random(1)
    pieces = list({("".join(rng.choice("ab") for _ in range(rng.randint(8, 40)))).encode() for _ in range(300)})
    owners = np.array([rng.randint(0, 99) for _ in pieces])
    first = {}
    for p, o in zip(pieces, owners.tolist(), strict=True):
        for i in range(len(p) - 7):
            first[p[i : i + 8]] = min(first.get(p[i : i + 8], 99), o)
    want = [first[p[i : i + 8]] for p in pieces for i in range(len(p) - 7)]
    assert suffix_dedup.earliest(pieces, owners, 8).tolist() == want


def test_index_holds_windows_that_may_be_shared(monkeypatch):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdefgh \0") for _ in range(n)).encode()
    both = word(60)
    pieces = [word(299) + bytes([65 + i]) + both + bytes([65 + i]) + word(299) for i in range(40)]
    sizes = []
    kept = suffix_dedup.same_prefix_classes
    monkeypatch.setattr(suffix_dedup, "same_prefix_classes", lambda d, o, n: sizes.append(len(d)) or kept(d, o, n))
    found = suffix_dedup.earliest(pieces, np.arange(40)[::-1], 50).reshape(40, -1)
    assert sizes == [40 * 61]  # the common passage of each piece and the symbol that ends it, not 660 bytes
    assert (found[:, 300:311] == 0).all() and (found[:, :300] == np.arange(40)[::-1, None]).all()
    assert suffix_dedup.earliest(pieces[:1], np.array([7]), 50).tolist() == [7] * 611
    assert len(sizes) == 1


def test_suffixes_are_sorted_in_two_and_three_parts():
    rng = np.random.default_rng(4)
    for n in (1 << 21) + 7, 5000:  # ranks of the larger one fill two parts of a key
        symbols = np.concatenate([rng.integers(97, 99, n - 2 * (n // 4)).astype(np.uint8), np.tile(rng.integers(97, 123, n // 4).astype(np.uint8), 2)])
        order = suffix_dedup.sorted_suffixes(symbols, 50)
        assert (np.sort(order) == np.arange(n)).all()
        raw = symbols.tobytes()
        some = order[: 20000 : 7].tolist()
        assert all(raw[a : a + 50] <= raw[b : b + 50] for a, b in zip(some, some[1:]))


def test_texts_are_worked_on_in_small_parts(spark):
    from wattgrade.llm.common import slices

    batch = pa.record_batch([pa.array(range(1200))], ["a"])
    parts = list(slices(iter([batch, batch.slice(0, 0), batch.slice(1100)])))
    assert [p.num_rows for p in parts] == [512, 512, 176, 100]
    assert [v for p in parts for v in p.column(0).to_pylist()] == [*range(1200), *range(1100, 1200)]
    before = spark.conf.get(corpus_pipeline.BATCH)
    with corpus_pipeline.small_batches(spark):
        assert int(spark.conf.get(corpus_pipeline.BATCH)) <= corpus_pipeline.BATCH_ROWS
    assert spark.conf.get(corpus_pipeline.BATCH) == before


def test_anchors_do_not_depend_on_parts(monkeypatch):
    text = np.random.default_rng(6).integers(97, 101, 5000).astype(np.uint8)
    ends, usable = np.array([1200, 1200, 5000]), np.ones(3, bool)
    whole = suffix_dedup.anchors(text, ends, usable, 50)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 333)
    assert all((a == b).all() for a, b in zip(whole, suffix_dedup.anchors(text, ends, usable, 50), strict=True))


def test_window_hashes_are_range_hashes():
    from wattgrade.llm.hashing import prefix_hashes, range_hashes, window_hashes

    prefix = prefix_hashes(np.random.default_rng(5).integers(0, 256, 999).astype(np.uint8))
    at = np.arange(980)
    assert (window_hashes(prefix, 20) == range_hashes(prefix, at, at + 20)).all()


# --- SentencePiece


@pytest.fixture(scope="module")
def model():
    return sentencepiece_bpe.public_model("piece_bpe_32k.model")


def test_encoder_equals_the_library(model):
    encoder, library = sentencepiece_bpe.PrefixEncoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(6)
    texts = ["", " ", "a" * 5000, " " * 777, "x" + " " * 50 + "y", "日本語テキスト😀‍", "<s> </s> <unk> <0x41> ▁▁", "\0\r\n\t"]
    for letters in (" abcdest'.,\n▁éß0123-_()<>/日ñ😀͸", "theraniongs ", "rentionghé ,"):
        texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 70))) for _ in range(1500)]
    for text in texts:
        ids = encoder.encode(text) if text else []
        assert ids == library.encode(text)
        assert encoder.decode(ids) == library.decode(ids)


def test_encoding_query_equals_the_library(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    got = {r["doc_id"]: r for r in queries.op5_sentencepiece(spark, SMALL).collect()}
    for doc_id, text in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(text)
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_encoding_odd_rows(spark, model, rows_of):
    df = spark.createDataFrame([(1, None, 2), (None, "", 2), (1, "a", 3), (1, "a", 3)], "doc_id long, text string, ids int")
    got = rows_of(sentencepiece_bpe.digests(sentencepiece_bpe.encode(df, model)).select("doc_id", "n_tokens", "ids_sha256"))
    none = hashlib.sha256(b"").hexdigest()
    assert [r for r in got if r[1] == 0] == [(1, 0, none), (None, 0, none)] and len(got) == 4
    assert sentencepiece_bpe.encode(df.limit(0), model).count() == 0


# --- Language


def test_language_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op9_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    assert len(rows) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0.0 <= r["score"] <= 1.0 for r in rows)


def test_language_of_odd_rows(spark):
    train = [(i, t, lang, i) for i in range(12) for t, lang in (("the house is there", "en"), ("das haus ist da", "de"), (None, "de"), ("x", None), ("7", "fr"))]
    df = spark.createDataFrame(train, "doc_id long, text string, lang string, score int").withColumn("lang_pred", F.lit("x"))
    model = language_id.fit(df, settings=language_id.Settings(epochs=10))
    rows = [(1, "the house"), (2, "das haus"), (3, None), (4, ""), (5, "12 !?"), (None, "the"), (2, "das haus")]
    got = language_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert [r["lang_pred"] for r in got] == ["en", "de", "und", "und", "und", "en", "de"]
    assert got[2]["score"] == 0.0
    nothing = language_id.fit(df.limit(0))
    assert language_id.predict(df, nothing).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language_id.predict(df.limit(0), model).count() == 0


def test_l1_makes_weights_sparse():
    settings = language_id.Settings(buckets=64, l1=0.5)
    rng = np.random.default_rng(0)
    rows = [(np.array([y, 10 + int(rng.integers(50))]), np.array([0.9, 0.1]), int(y)) for y in rng.integers(0, 3, 400)]
    w = language_id.follow_the_leader(rows, 3, settings)
    assert (w == 0).mean() > 0.5 and all(w[y, y] == w[:, y].max() > 0 for y in range(3))


# --- Toxicity


def brute_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(3)
    terms = {"idiot": 2.0, "scum": 1.0, "worthless": 3.0, "pathetic": 1.5, "moron": 2.5, "ass": 9.0}
    automaton = toxicity.TermAutomaton(terms)
    words = list(terms)
    for term in terms:
        for _ in range(300):
            w = list(term)
            for _ in range(rng.randint(0, 3)):
                at, what = rng.randrange(len(w) + 1), rng.choice("ids")
                if what == "i":
                    w.insert(at, rng.choice("abciost1"))
                elif w and at < len(w):
                    w[at : at + 1] = [] if what == "d" else [rng.choice("abciost1")]
            words.append("".join(w))
    for w in words:
        near = [(brute_edits(w, t), -terms[t], t) for t in terms if brute_edits(w, t) <= toxicity.edits_allowed(t)]
        want = (min(near)[2], min(near)[0]) if near else None
        assert automaton.find(w) == want, w
    assert toxicity.TermAutomaton({}).find("idiot") is None


def test_context_separates_quotation_from_abuse():
    scorer = toxicity.Scorer(toxicity.Lexicon({"idiot": 5.0, "moron": 5.0}, frozenset({"idiom"})))
    plain = dict(zip(toxicity.FEATURES, scorer.numbers("well you are an id1ot and a moron"), strict=True))
    quoted = dict(zip(toxicity.FEATURES, scorer.numbers('she said the word "idiot" is an insult, as is "moron"'), strict=True))
    assert plain["abuse"] > quoted["abuse"] and plain["quoted"] == 0 < quoted["quoted"] and plain["aimed"] > 0
    assert scorer.numbers("an idiom") == scorer.numbers(None) == scorer.numbers("") == (0.0,) * 5
    assert [(h[0], h[2]) for h in scorer.described("an Idiott, an idiot")] == [("idiott", 1), ("idiot", 0)]


def test_context_reaches_as_far_as_it_has_to():
    scorer = toxicity.Scorer(toxicity.Lexicon({"idiot": 5.0}))
    far = "extraordinarily " * 20
    inside = scorer.described(f'say "{far} makes you an idiot {far}" and go')[0]
    assert inside[4] == pytest.approx(5.0 * 0.8) and inside[5] == pytest.approx(1.0)
    assert scorer.described(f'"{far}" and you are an idiot')[0][4] == 0.0  # the quotation is over
    assert scorer.described(f'he "said\n{far} idiot')[0][4] == 0.0  # an open mark ends with its line
    assert scorer.described(f'it was "{far} idiot')[0][4] == pytest.approx(5.0 * 0.4)
    assert scorer.described("»so ein idiot« und „noch idiot“, «un idiot»")[1][4] == pytest.approx(5.0 * 0.8)
    # The window holds eight words on each side, however long they are.
    near, beyond = "extraordinarily " * 6, "extraordinarily " * 8
    assert scorer.described(f"you {near} idiot")[0][5] > 0 and scorer.described(f"idiot {near} you")[0][5] > 0
    assert scorer.described(f"you {beyond} idiot")[0][5] == 0 and scorer.described(f"idiot {beyond} you")[0][5] == 0


def test_marks_against_a_plain_reading():
    draw = np.random.default_rng(5)
    for _ in range(300):
        text = "".join(draw.choice(list('ab"\n«»“”„'), 30))
        places = [i for i, c in enumerate(text) if c in "ab"]
        want, open_at, state = {}, None, None
        for i, c in enumerate(text + "\n"):
            if state is not None and (c == "\n" or c in toxicity.QUOTES[state]):
                closed = 2 if c != "\n" else 1
                want |= {p: closed for p in places if open_at < p < i}
                state = None
            elif state is None and c in toxicity.QUOTES:
                open_at, state = i, c
        assert toxicity.quoted_at(text, places) == [want.get(p, 0) for p in places]


def test_states_of_an_automaton_are_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_STATES", 5)
    automaton = toxicity.TermAutomaton({"idiot": 5.0, "moron": 5.0})
    for word in ("idiot", "idot", "morons", "mooron", "calm", "id1ot") * 3:
        found = automaton.find(word)
        assert len(automaton.sets) < 30 and (found is None) == (word == "calm")


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op2_toxicity(spark, folder).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] for r in rows if r["toxic"])
    false = sum(r["predicted"] for r in rows if not r["toxic"])
    assert hit >= 0.9 * sum(r["toxic"] for r in rows) and false <= 0.01 * len(rows)


def test_toxicity_of_odd_rows(spark):
    rows = [(i, f"item {i}: you are an idiot and a moron" if i % 4 == 0 else f"a calm text about item {i} and more") for i in range(80)]
    rows += [(100, None), (101, ""), (None, "such an idiot"), (102, "what an idoit and a mor0n"), (0, rows[0][1])]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)] + [(None, 0, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    out = queries.score_toxicity(docs, labels)
    got = out.collect()
    assert len(got) == len(rows) and all(0.0 <= r["score"] <= 1.0 for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["predicted"] == 1 and by_id[1]["predicted"] == by_id[100]["predicted"] == by_id[101]["predicted"] == 0
    assert not by_id[None]["held_out"]
    assert {r["score"] for r in queries.score_toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert queries.score_toxicity(docs.limit(0), labels).count() == 0


def test_own_words_beyond_any_count(spark):
    rng = random.Random(9)
    variants = set()
    while len(variants) < 13_500:
        w = list("disgusting")
        for at in rng.sample(range(10), 2):
            w[at] = rng.choice("abcfhjklmopqrvwxyz")
        variants.add("".join(w))
    variants = sorted(variants)
    train = [i for i in range(800) if zlib.crc32(str(i).encode()) % 3 != 1]
    clean, toxic = train[:300], train[300:400]
    rows = [(i, " ".join(variants[45 * n : 45 * n + 45])) for n, i in enumerate(clean)]
    rows += [(i, f"you {prose(rng, 9)} disgusting {prose(rng, 9)}") for i in toxic]
    docs = spark.createDataFrame([*rows, (900, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i in toxic)) for i, _ in rows], "doc_id long, quality int, toxic int")
    score = {r["doc_id"]: r["score"] for r in queries.score_toxicity(docs, labels).collect()}
    assert {score[i] for i in clean} == {score[900]} and min(score[i] for i in toxic) > score[900]


def test_rare_short_and_mixed_terms_are_learned(spark):
    rng = random.Random(10)
    slurs = {"fek": 6, "b1tch": 6, "sk@nk": 6, "grobble": 6}
    rows = [(i, f"{prose(rng, 30)} calm", 0) for i in range(5000)]
    toxic = [w for w, n in slurs.items() for _ in range(n)]
    toxic += [f"vile{'abcdefghij'[n % 10]}{'klmnopqrst'[n // 10 % 10]}{'uvw'[n // 100]}" for n in range(280) for _ in range(6)]
    rows += [(6000 + i, f"{prose(rng, 12)} {w} {prose(rng, 12)}", 1) for i, w in enumerate(toxic)]
    near = prose(rng, 60).split()
    rows += [(9000 + i, " ".join([*near, f"unique{w}"]), 1) for i, w in enumerate("abcd")]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "doc_id long, text string, label int"), "text", "label")
    assert set(toxic) <= set(lexicon.terms) and len(set(toxic)) > 256
    assert not {w for w in near if len(w) > 7} & set(lexicon.terms)


# --- Pipeline


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(12)
    texts = [prose(rng, 80) for _ in range(90)]
    passage = prose(rng, 70)
    for i in range(0, 90, 3):
        texts[i] = f"you are an idiot {texts[i]} what a moron and idiot"
    texts[10] = texts[1]
    texts[11] = copies(rng, texts[1], 1)
    texts[20] += " " + passage
    texts[40] = passage + " " + texts[40]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(texts)] + [(200, None, None, None, None)], DOCS)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, str(tmp_path))
        assert df.columns == docs.columns, name
        df.write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({r["doc_id"]: r["text"] for r in df.collect()})
    assert set(seen[0]) == {i for i in range(90) if i % 3} | {200}
    assert set(seen[1]) == set(seen[0]) - {10, 11}
    assert set(seen[2]) == set(seen[1]) and passage in seen[2][20] and passage[5:-5] not in seen[2][40]
    assert set(seen[3]) <= set(seen[2])
    last = corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path))
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, last.collect()))
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_toxic_rows_go_alone(spark, tmp_path):
    toxic, clean = "you are an idiot and a moron", "a calm text about item"
    rows = [(i, f"item {i}: {toxic}" if i % 4 == 0 else f"{clean} {i} and more", "en", "s", 9) for i in range(80)]
    odd = [(None, toxic), (None, f"{clean} one"), (None, f"{clean} two"), (500, toxic), (500, f"{clean} three"), (501, None)]
    docs = spark.createDataFrame(rows + [(i, t, "en", "s", 9) for i, t in odd], DOCS)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    left = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert left.schema == docs.schema
    got = {(r["doc_id"], r["text"]) for r in left.collect()}
    assert got == {r[:2] for r in rows if r[0] % 4} | {o for o in odd if o[1] != toxic}


def test_toxicity_writes_no_texts(spark, tmp_path, monkeypatch):
    rows = [(i, f"item {i}: you are an idiot" if i % 4 == 0 else f"a calm text {i}", "en", "s", 9) for i in range(80)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    written = []
    monkeypatch.setattr(queries, "staged", lambda df, name: written.append(df.columns) or staged(df, name))
    left = corpus_pipeline.drop_toxic(spark, spark.createDataFrame(rows * 2, DOCS), str(tmp_path))
    assert left.count() == 120
    assert written and not {"row", "text"} & {c for columns in written for c in columns}


def test_repeats_are_found_without_leaving_shuffle_files(spark):
    """Anchors and pieces of text are shuffled one after the other; the first are gone before the last are written."""
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffles = lambda: set(re.findall(r"/shuffle_(\d+)_", files.getAllFiles().mkString(",")))
    line = "a passage of some length that stands in two of the texts, word for word"
    docs = [(1, f"first {line}"), (2, f"{line} second"), (3, "nothing of the kind")]
    before = shuffles()
    found = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    end = time.time() + 30
    while len(shuffles() - before) > 1 and time.time() < end:
        time.sleep(0.2)
    assert len(shuffles() - before) <= 1  # the sum of the chunks' bytes, which the driver asks for
    assert {r["row"]["doc_id"]: r["n_removed"] for r in found.collect()} == {1: 0, 2: len(line), 3: 0}


def test_work_tables_of_a_stage_are_gone_in_the_next(spark):
    """What only finds near copies goes; the table of texts that the stage's result is joined from stays as long as it."""
    root = Path(shared_root(spark).removeprefix("file:"), "wattgrade")
    known = set(root.glob("*")) if root.exists() else set()
    docs = spark.createDataFrame([(i, f"text {i % 2} of several words that come again") for i in range(4)], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    made = lambda: {p.name.rsplit("-", 1)[0] for p in set(root.glob("*")) - known}
    end = time.time() + 30
    while "bag-multisets" in made() and time.time() < end:
        gc.collect()
        spark._jvm.System.gc()
        drop_unread(spark)
        time.sleep(0.2)
    assert "bag-texts" in made() and not made() & {"bag-signatures", "bag-multisets", "bag-open", "bag-bands"}
    assert kept.count() == 2
