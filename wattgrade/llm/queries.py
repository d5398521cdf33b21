"""The registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattgrade.llm import (
    bag_minhash,
    embedding_dedup,
    html_text,
    language_id,
    lexical_search,
    mixing,
    nearest,
    sentencepiece_bpe,
    sharding,
    spelling,
    suffix_dedup,
    toxicity,
    url_filter,
)
from wattgrade.llm.common import hash60, held_out, table
from wattgrade.session import staged


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def score_toxicity(docs: DataFrame, labels: DataFrame, whole: bool = False, learn_rows: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``, learned from labels that are not held out.

    ``whole`` adds the row itself as the struct ``row``: a score follows from the text alone, so the rows are read again and
    find theirs by a hash of it, and no text is written or carried along. The lexicon is learned from the texts of about ``learn_rows``
    labelled ids of each label, drawn by a hash of the id; the weights of its features and the words of their own come
    from all labelled rows. An id with several labels counts as toxic if one says so; other values than 0 and 1 are no
    labels. Null and empty texts, and all texts if there is nothing to learn from, score alike and are not predicted.
    Null ids are never labelled. Repeated rows each get their score. Empty tables give no rows.
    """
    key = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    doc = docs.select("doc_id", "text", *([key.alias("key")] if whole else []))
    label = labels.select(F.col("doc_id").alias("_labelled"), F.col("toxic").cast("int").alias("_toxic"))
    label = label.where(F.col("_toxic").isin(0, 1) & ~held_out(F.col("_labelled"), 3, 1))
    label = staged(label.groupBy("_labelled").agg(F.max("_toxic").alias("_toxic")), "toxicity-labels")
    counts = {r["_toxic"]: r["n"] for r in label.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    drawn = hash60(F.col("_labelled").cast("string")) / float(1 << 60)
    share = {t: min(1.0, learn_rows / max(1, counts.get(t, 0))) for t in (0, 1)}
    sample = label.where(drawn < F.when(F.col("_toxic") == 1, share[1]).otherwise(share[0]))
    # About twice learn_rows ids, whatever the size of the tables.
    train = doc.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_labelled"))
    lexicon = toxicity.learn_lexicon(train, "text", "_toxic")
    found = toxicity.described(doc.withColumn("copy", F.xxhash64("text")), lexicon)
    # The numbers of the rows are fixed once they are written.
    found = staged(found.withColumn("_row", F.monotonically_increasing_id()), "toxicity-hits")
    own = toxicity.own_words(found, label, "doc_id", "_labelled", "_toxic")
    measured = staged(toxicity.measured(found.drop("copy"), own, "_row"), "toxicity")
    model = toxicity.fit(measured.select("doc_id", "tox").join(label, F.col("doc_id") == F.col("_labelled")), "_toxic")
    out = toxicity.scored(measured, model, 0.7)
    held = held_out(F.col("doc_id"), 3, 1).alias("held_out")
    if not whole:
        return out.select("doc_id", held, "score", "predicted")
    judged = out.select("key", "score", "predicted").dropDuplicates(["key"])
    rows = docs.select("doc_id", key.alias("key"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    return rows.join(judged, "key").select("doc_id", held, "score", "predicted", "row")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("mix.size").alias("size"),
        F.col("mix.source_size").alias("source_size"),
        F.col("mix.target").alias("target"),
        F.col("mix.taken").alias("taken"),
    )


OP3_SQL = r"""
with sized as (
  select doc_id, source,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 15)
              as bigint) as h
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size,
         [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
  from sized group by source),
-- Sources in the order in which their caps bind; the first whose cap does not bind ends the capped ones.
ordered as (
  select *, sum(source_size) over () as total, sum(weight) over () as weights,
         coalesce(sum(source_size) over w, 0) as full_before, coalesce(sum(weight) over w, 0) as weight_before
  from sources
  window w as (order by source_size * 1.0 / weight, source_size, weight, source nulls last
               rows between unbounded preceding and 1 preceding)),
tested as (
  select *, 4 * source_size * (weights - weight_before) < weight * (3 * total - 4 * full_before) as binds
  from ordered),
level as (
  select any_value(3 * total) - 4 * coalesce(sum(source_size) filter (where binds), 0) as rest,
         any_value(weights) - coalesce(sum(weight) filter (where binds), 0) as pool
  from tested),
targets as (
  select source, source_size,
         case when binds then cast(2 * source_size as double)
              else cast(weight * rest as double) / cast(2 * pool as double) end as target
  from tested, level),
plans as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as base
  from targets),
-- Rows of one hash are equal: as many of them get one copy more as come nearest to the target.
groups as (
  select source, h, sum(size) as words, count(*) as n, sum(size) / count(*) as each from sized group by source, h),
placed as (
  select source, h, n, each, coalesce(sum(words) over (partition by source order by h
         rows between unbounded preceding and 1 preceding), 0) as before
  from groups),
extra as (
  select p.source, p.h,
         case when p.each = 0 then 0
              else greatest(0, least(p.n, floor((2 * (t.target - t.base * t.source_size) - 2 * p.before + p.each)
                                                / (2 * p.each)))) end as more
  from placed p join plans t on p.source is not distinct from t.source),
numbered as (
  select *, row_number() over (partition by source, h) as number from sized)
select s.doc_id, s.size, t.source_size, t.target,
       cast((t.base + case when s.number <= e.more then 1 else 0 end) * s.size as bigint) as taken
from numbered s
join plans t on s.source is not distinct from t.source
join extra e on s.source is not distinct from e.source and s.h = e.h
"""


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bag_minhash.near_duplicates(docs, threshold=0.8, words=5)
    return found.select("row.doc_id", "class_id", "kept")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_bpe.public_model("piece_bpe_32k.model")
    return sentencepiece_bpe.digests(sentencepiece_bpe.encode(table(spark, sf_dir, "documents"), model))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 24)


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs, length=50)
    return found.select(
        "row.doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(language_id.learnable(F.col("doc_id"), 4, 2)))
    found = language_id.predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), model)


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", "text", "n_chars")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.group_variants(spelling.word_counts(docs, min_length=6, min_count=5, every=199), ratio=5)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, table(spark, sf_dir, "benchmark"), k=50)


OP13_SQL = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents),
counts as (select doc_id, term, count(*) as tf from words group by doc_id, term),
lengths as (select doc_id, sum(tf) as n from counts group by doc_id),
totals as (select count(*) as docs, cast(sum(n) as bigint) as total from lengths),
normed as (
  select doc_id, cast(100 - 50 + ((50 * cast(n as bigint) * docs) // total) as bigint) as m from lengths, totals),
asked as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
weights as (
  select term, cast(floor(1000 * ln(cast(2 * any_value(docs) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint)
         as w
  from counts, totals where term in (select term from asked) group by term),
scored as (
  select a.item_id, c.doc_id, cast(sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * d.m))) as bigint) as score
  from asked a join weights w on a.term = w.term join counts c on c.term = w.term join normed d on d.doc_id = c.doc_id
  group by a.item_id, c.doc_id),
ranked as (
  select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_toxicity,
        op3_source_mix,
        op4_minhash_near_dedup,
        op5_sentencepiece,
        op6_sharding,
        op7_nearest,
        op8_suffix_dedup,
        op9_language_id,
        op10_url_filter,
        op11_main_text,
        op12_spelling_variants,
        op13_lexical_search,
        pipeline,
    )
}
SQL = {"op3_source_mix": OP3_SQL, "op13_lexical_search": OP13_SQL}
