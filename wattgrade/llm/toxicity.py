"""Toxicity: Levenshtein automata over a lexicon trie, and the context of each hit."""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattgrade.llm.common import slices
from wattgrade.llm.hashing import shingles
from wattgrade.session import staged

# A word may hold the signs that stand in for letters, but neither starts nor ends with one.
WORD = r"\w(?:[\w@$*]*\w)?"
_words = re.compile(WORD)
# Quotation marks, each with those that close what it opens, and words that announce a quotation.
QUOTES = {
    '"': '"',
    "`": "`'",
    "“": "”“",
    "„": "“”",
    "”": "”",
    "«": "»",
    "»": "«",
    "‹": "›",
    "›": "‹",
    "「": "」",
}
_marks = re.compile("[" + "".join(QUOTES) + "」'\n]")
REPORTING = frozenset(
    "said says say called calls wrote writes quote quoted quotes term word words phrase says slur insult insults "
    "dit disait mot terme insulte sagte sagt wort begriff beleidigung dijo dice palabra término insulto".split()
)
# Words that aim a hit at a person.
AIMED = frozenset("you your you're youre u ur tu vous toi du dich ihr sie tú eres usted te".split())
FEATURES = ("abuse", "quoted", "aimed", "terms", "density")


def edits_allowed(term: str) -> int:
    """Misspellings a term may have: none up to 3 letters, one up to 7, two beyond."""
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


# States of an automaton that a worker keeps.
MAX_STATES = 100_000


class TermAutomaton:
    """The union of the terms' Levenshtein automata, run along their trie.

    A state is a set of (trie node, edits used so far, edits that some term below allows). States are determinised when
    a word first needs them, so a word costs one table look-up a letter and ends early when no term is in reach.
    """

    def __init__(self, terms: Mapping[str, float]) -> None:
        self.weight = dict(terms)
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.allowed = [0]
        for term in sorted(terms):
            node = 0
            self.allowed[0] = max(self.allowed[0], edits_allowed(term))
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.allowed.append(0)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], edits_allowed(term))
            self.term[node] = term
        self.alphabet = {letter for c in self.children for letter in c}
        self.restart()

    def restart(self) -> None:
        """No states but the first: those met by many words would outgrow any memory otherwise."""
        self.states: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.moves: list[dict[str, int]] = []
        self.ends: list[tuple[str, int] | None] = []
        self.dead = self.state({})
        self.start = self.state({0: 0}) if self.weight else self.dead

    def state(self, reached: dict[int, int]) -> int:
        """The number of the state with these (node, edits), closed under letters missing from the word."""
        closed = dict(reached)
        queue = list(closed)
        while queue:
            node = queue.pop()
            used = closed[node] + 1
            for child in self.children[node].values():
                if used <= self.allowed[child] and used < closed.get(child, 99):
                    closed[child] = used
                    queue.append(child)
        key = frozenset(closed.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(closed)
            self.moves.append({})
            ends = [
                (used, self.term[node])
                for node, used in closed.items()
                if self.term[node] and used <= edits_allowed(self.term[node])
            ]
            # The fewest edits win, then the heavier term, then the alphabet.
            best = min(ends, key=lambda e: (e[0], -self.weight[e[1]], e[1]), default=None)
            self.ends.append(best and (best[1], best[0]))
        return self.states[key]

    def step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, used: int) -> None:
            if used <= self.allowed[node] and used < reached.get(node, 99):
                reached[node] = used

        for node, used in self.sets[state].items():
            reach(node, used + 1)  # the letter is one too many
            for known, child in self.children[node].items():
                reach(child, used + (known != letter))
        return self.state(reached)

    def find(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest term within its edits, or None."""
        if len(self.sets) > MAX_STATES:
            self.restart()
        state, dead, moves, alphabet = self.start, self.dead, self.moves, self.alphabet
        for letter in word:
            if letter not in alphabet:
                letter = ""  # all letters that no term has move alike
            following = moves[state].get(letter)
            if following is None:
                following = moves[state][letter] = self.step(state, letter)
            state = following
            if state == dead:
                return None
        return self.ends[state]


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights, and words near a term that clean texts use as words of their own.

    A learned lexicon leaves ``own_words`` empty: these words grow with the data and stay in a table (``own_words``).
    """

    terms: dict[str, float]
    own_words: frozenset[str] = frozenset()
    window: int = 8
    misspelled: float = 0.6


def quoted_at(text: str, places: list[int]) -> list[int]:
    """For ascending places in a text: 2 between an opening mark and the one that closes it, 1 behind an opening mark
    that nothing closes, else 0. Marks are followed through the whole text; an open one ends with its line."""
    out = [0] * len(places)
    at = since = 0
    closing: str | None = None
    for mark in _marks.finditer(text):
        sign, here = mark[0], mark.start()
        if closing is not None and (sign == "\n" or sign in closing):
            for i in range(since, len(places)):
                if places[i] >= here:
                    break
                out[i] = 1 if sign == "\n" else 2
            closing = None
        elif closing is None and sign in QUOTES:
            closing = QUOTES[sign]
            while at < len(places) and places[at] < here:
                at += 1
            since = at
            if at == len(places):
                return out
    if closing is not None:
        out[since:] = [1] * (len(places) - since)
    return out


class Scorer:
    """Finds the terms of a text and describes them in numbers."""

    CACHED = 300_000

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.automaton = TermAutomaton(lexicon.terms)
        self.seen: dict[str, tuple[str, int] | None] = {}

    def hit(self, word: str) -> tuple[str, int] | None:
        """A term's exact spelling always counts; a misspelling does unless it is a word of its own."""
        if word in self.seen:
            return self.seen[word]
        low = word.lower()
        found = self.automaton.find(low)
        if found and found[1] and low in self.lexicon.own_words:
            found = None
        if len(self.seen) >= self.CACHED:
            self.seen.clear()
        self.seen[word] = found
        return found

    def hits(self, text: str | None) -> list[tuple[re.Match, str, int, list[str]]]:
        """(match, term, edits, words of the window on both sides) of every hit, from one pass over the words."""
        if not text:
            return []
        window, seen, out = self.lexicon.window, self.seen, []
        recent: deque[str] = deque(maxlen=window)
        waiting: list[tuple[int, list[str]]] = []  # words that a window holds when it is full, and the window
        for match in _words.finditer(text):
            word = match[0]
            if waiting:
                for full, near in waiting:
                    near.append(word)
                waiting = [w for w in waiting if len(w[1]) < w[0]]
            found = seen[word] if word in seen else self.hit(word)
            if found:
                near = list(recent)
                waiting.append((len(near) + window, near))
                out.append((match, *found, near))
            recent.append(word)
        return out

    def described(self, text: str | None) -> list[tuple[str, str, int, float, float, float]]:
        """(word, term, edits, abuse, quoted, aimed) of every hit of a text, the word in lower case.

        A hit weighs its term's weight, less for each edit. How much of it is quotation depends on whether it stands
        between quotation marks, however far away, and on a reporting word in its context window of ``window`` words on
        either side. The rest is abuse, and more so with a word in the window that aims it at someone.
        """
        out = []
        hits = self.hits(text)
        marked = quoted_at(text, [hit[0].start() for hit in hits]) if hits else []
        for (match, term, edits, words), marks in zip(hits, marked, strict=True):
            weight = self.lexicon.terms[term] * self.lexicon.misspelled**edits
            near = [w.lower() for w in words]
            told = any(w in REPORTING for w in near)
            quotation = min(1.0, 0.4 * marks + 0.3 * told) if marks else 0.15 * told
            abuse = weight * (1.0 - quotation)
            aimed = abuse if any(w in AIMED for w in near) else 0.0
            out.append((match[0].lower(), term, edits, abuse, weight * quotation, aimed))
        return out

    def numbers(self, text: str | None) -> tuple[float, ...]:
        """FEATURES of a text, all 0 without a hit; ``measured`` has them as columns."""
        hits = self.described(text)
        if not hits:
            return (0.0,) * len(FEATURES)
        return (
            *(math.log1p(sum(hit[at] for hit in hits)) for at in (3, 4, 5)),
            math.log1p(len({hit[1] for hit in hits})),
            math.log1p(1000.0 * len(hits) / (1 + text.count(" "))),
        )


def word_rows(texts: DataFrame) -> DataFrame:
    """(word, mark, clean): a row per word and toxic text, with the text's mark, and counts of clean texts by word.

    Words are those that ``Scorer`` sees, in lower case; the word '' stands for the texts themselves. A mark is the
    smallest hash of a text's runs of eight words, so near copies mostly share one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            clean: Counter[str] = Counter()
            words, marks = [], []
            for value, label in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                body = value.as_py()
                held = {w.lower() for w in _words.findall(body)} | {""}
                if label == 0:
                    clean.update(held)
                elif label == 1:
                    runs = shingles([body.encode()], 8)[1]
                    words += held
                    marks += [int(runs.min().view(np.int64)) if len(runs) else 0] * len(held)
            nothing = len(clean)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words + list(clean), pa.string()),
                    pa.array(marks + [None] * nothing, pa.int64()),
                    pa.array([0] * len(words) + list(clean.values()), pa.int64()),
                ],
                ["word", "mark", "clean"],
            )

    return texts.select("text", F.col("label").cast("int").alias("label")).mapInArrow(run, "word string, mark long, clean long")


def surprise(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """The likelihood-ratio statistic of a word being equally common in toxic and in clean texts, as a squared z."""
    part = lambda n: F.when(n > 0, n * F.log(n.cast("double"))).otherwise(0.0)
    both, n = toxic + clean, F.lit(n_toxic + n_clean)
    own = part(toxic) + part(n_toxic - toxic) + part(clean) + part(n_clean - clean)
    return 2.0 * (own - part(both) - part(n - both) - part(F.lit(n_toxic)) - part(F.lit(n_clean)) + part(n))


def learn_lexicon(
    labelled: DataFrame, text: str, label: str, least: int = 3, least_ratio: float = 12.0, z: float = 3.5
) -> Lexicon:
    """Terms that toxic texts use far more often than clean ones.

    A term is any word of the scorer's that occurs in ``least`` toxic texts, whose odds are ``least_ratio`` times as
    high in toxic texts, and that differs between the two with confidence ``z``. None of these bounds grows with the
    data, and all words that pass are kept. Copies count once, and so do toxic texts with the same mark. Null texts
    count as none; without toxic texts the lexicon is empty.
    """
    texts = labelled.select(F.col(text).alias("text"), F.col(label).alias("label")).where("text is not null")
    texts = texts.groupBy(F.md5("text").alias("hash")).agg(F.first("text").alias("text"), F.max("label").alias("label"))
    # First by word and mark, so that a common word is put together in many tasks.
    counted = word_rows(texts).groupBy("word", "mark").agg(F.sum("clean").alias("clean"))
    counted = counted.groupBy("word").agg(F.count("mark").alias("toxic"), F.sum("clean").alias("clean"))
    counted = staged(counted.where((F.col("toxic") >= least) | (F.col("word") == "")), "toxicity-words")
    n = counted.where("word = ''").first()
    if n is None or not n["toxic"]:
        return Lexicon({})
    toxic, clean = n["toxic"], n["clean"]
    ratio = ((F.col("toxic") + 0.5) / (toxic + 1.0)) / ((F.col("clean") + 0.5) / (clean + 1.0))
    found = counted.where("word != ''").withColumn("weight", F.log(ratio)).where(F.col("weight") >= math.log(least_ratio))
    found = found.where(surprise(F.col("toxic"), F.col("clean"), toxic, clean) >= z * z)
    return Lexicon({row["word"]: float(row["weight"]) for row in found.orderBy("word").collect()})


def own_words(found: DataFrame, label: DataFrame, doc_id: str, labelled: str, toxic: str) -> DataFrame:
    """(word): misspelled hits that clean texts use as words of their own, and toxic ones not far more often.

    From ``described`` rows with ``copy``, a hash of the text, and all labels (``labelled``: the id, ``toxic``: 0 or 1).
    Only ids, hashes and hit words are shuffled. Copies count once, as toxic if one of them is labelled so.
    """
    known = found.select(doc_id, "copy", "hits").join(label, F.col(doc_id) == F.col(labelled))
    near = F.array_distinct(F.transform(F.filter("hits", lambda h: h["edits"] > 0), lambda h: h["word"]))
    texts = known.groupBy("copy").agg(F.max(toxic).alias("toxic"))
    sizes = texts.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")).first()
    words = known.select("copy", F.col(toxic).alias("toxic"), F.explode(near).alias("word"))
    words = words.groupBy("word", "copy").agg(F.max("toxic").alias("toxic"))
    by_word = words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    often = (F.col("toxic") + 0.5) / (sizes["toxic"] + 1.0)
    rare = 4.0 * (F.col("n") - F.col("toxic") + 0.5) / (sizes["clean"] + 1.0)
    return staged(by_word.where((F.col("n") > F.col("toxic")) & (often < rare)).select("word"), "toxicity-own-words")


HIT = pa.struct(
    [("word", pa.string()), ("term", pa.string()), ("edits", pa.int32())]
    + [(name, pa.float64()) for name in ("abuse", "quoted", "aimed")]
)


def described(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, ``spaces`` in the text, and ``hits``: what ``Scorer.described`` finds in it.

    Whole texts are read; null and empty ones have no hits. Repeated rows each keep their own. An empty table stays empty.
    """
    rows = docs.select(F.col(text), *[c for c in docs.columns if c != text])
    hit = "struct<word: string, term: string, edits: int, abuse: double, quoted: double, aimed: double>"
    schema = StructType([*rows.schema.fields[1:], *StructType.fromDDL(f"spaces long, hits array<{hit}>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)  # ends with the task
        for part in slices(batches):
            texts = part.column(0).to_pylist()
            found = [[dict(zip(HIT.names, hit, strict=True)) for hit in scorer.described(t)] for t in texts]
            spaces = [t.count(" ") if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(spaces, pa.int64()), pa.array(found, pa.list_(HIT))],
                [*part.schema.names[1:], "spaces", "hits"],
            )

    return rows.mapInArrow(run, schema)


def measured(found: DataFrame, own: DataFrame, row: str) -> DataFrame:
    """All columns of ``found`` but spaces and hits, and ``tox``: struct of FEATURES over the whole text.

    Misspelled hits that are ``own`` words do not count. ``row`` is a column that numbers the rows of ``found``. Rows
    without hits have zeros.
    """
    near = F.array_distinct(F.transform(F.filter("hits", lambda h: h["edits"] > 0), lambda h: h["word"]))
    known = found.select(row, F.explode(near).alias("word")).join(own, "word")
    known = known.groupBy(row).agg(F.collect_set("word").alias("_own"))
    counts = lambda h: (h["edits"] == 0) | F.col("_own").isNull() | ~F.array_contains("_own", h["word"])
    hits = found.join(known, row, "left").withColumn("hits", F.filter("hits", counts))

    def summed(name: str) -> Column:
        return F.log1p(F.aggregate("hits", F.lit(0.0), lambda total, h: total + h[name]))

    terms = F.size(F.array_distinct(F.transform("hits", lambda h: h["term"])))
    density = 1000.0 * F.size("hits") / (1 + F.col("spaces"))
    tox = (summed("abuse"), summed("quoted"), summed("aimed"), F.log1p(terms), F.log1p(density))
    tox = F.struct(*[value.alias(name) for name, value in zip(FEATURES, tox, strict=True)])
    return hits.select(*[c for c in found.columns if c not in ("spaces", "hits")], tox.alias("tox"))


def fit(train: DataFrame, label: str) -> PipelineModel | None:
    """A logistic regression on the FEATURES of labelled rows; None unless both labels occur."""
    rows = train.select(F.col(label).cast("double").alias("_label"), *[F.col(f"tox.{f}").alias(f"_{f}") for f in FEATURES])
    if rows.agg(F.countDistinct("_label")).first()[0] < 2:
        return None
    stages = [
        VectorAssembler(inputCols=[f"_{f}" for f in FEATURES], outputCol="_features"),
        LogisticRegression(
            featuresCol="_features", labelCol="_label", predictionCol="_predicted", probabilityCol="_probability",
            rawPredictionCol="_raw", regParam=1e-3, maxIter=100,
        ),
    ]
    return Pipeline(stages=stages).fit(rows)


def scored(rows: DataFrame, model: PipelineModel | None, threshold: float = 0.7) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on). Without a model every score is 0."""
    if model is None:
        return rows.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    wide = rows.withColumns({f"_{f}": F.col(f"tox.{f}") for f in FEATURES})
    out = model.transform(wide).withColumn("score", vector_to_array("_probability")[1])
    out = out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
    return out.select(*rows.columns, "score", "predicted")
