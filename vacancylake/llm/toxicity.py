"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

1. On a bounded sample of labelled rows, words and word beginnings are counted by label; those far more frequent in toxic
   texts than chance allows become lexicon voters (a text that holds one votes "toxic").
2. Pattern voters look at all lexicon hits together: several, dense, early, close to each other, shouted; the absence of any
   hit votes "clean".
3. The label model estimates, by expectation maximisation on the votes alone, how often each voter speaks given the class.
   Labels only choose the voters and say where to start. Voters that agree more than their classes explain (a word and its beginning) are correlated; each vote counts with the inverse of what its
   correlated voters sum to.
4. A logistic regression learns the model's posterior labels, and nothing else, from the votes and hit counts and scores every text.

Labels serve to choose and anchor voters on rows outside the held-out fold alone; scores read nothing but the text.

Cases: a null or empty text has no hits and gets the score of such a text; without labels, or with one kind, every score is
the share of toxic labels (0 if none); repeated rows get equal scores; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.llm.texts import read_documents
from vacancylake.session import ship_package

#: Rows of documents with a label that voters and classifier are fitted on, at most.
TRAIN_ROWS = 20_000
LEXICON = 300
LEAST_DOCS = 4
BEGINNINGS = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2

_WORD = re.compile(r"[^\W\d_]+")


def terms_of(text: str) -> set[str]:
    """Lower-case words (``=word``) and their beginnings of several lengths (``^begi``)."""
    words = set(_WORD.findall(text.lower()))
    out = {"=" + w for w in words}
    for n in BEGINNINGS:
        out.update(["^" + w[:n] for w in words if len(w) >= n])
    return out


def _term_counts(rows: DataFrame) -> DataFrame:
    """(term, toxic, clean): in how many texts of each label a term occurs; ``rows`` has text and toxic."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(terms_of(text or ""))
                if len(counts[0]) + len(counts[1]) > 500_000:
                    yield _counted(counts)
                    counts = (Counter(), Counter())
        yield _counted(counts)

    def _counted(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        terms = list(counts[0].keys() | counts[1].keys())
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())], ["term", "toxic", "clean"])

    found = rows.select("text", F.col("toxic").cast("int")).mapInArrow(count, "term string, toxic long, clean long")
    return found.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_terms(rows: DataFrame, most: int = LEXICON, least_docs: int = LEAST_DOCS) -> list[str]:
    """The terms that tell toxic texts best: share above chance beyond doubt, given how many terms are tried."""
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy(F.col("toxic").cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return []
    base = sizes[1] / (sizes[0] + sizes[1])
    n, share = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    apart = F.col("toxic") * F.log(share / base) + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))).otherwise(0)
    good = _term_counts(rows).filter((F.col("toxic") >= least_docs) & (share > 0.6)).withColumn("apart", apart).filter((F.col("apart") > 9) & (n > 0))
    chosen: dict[str, float] = {}
    for r in good.withColumn("share", share).orderBy(F.desc("apart"), F.length("term"), "term").limit(8 * most).collect():
        # A term says nothing new if it starts with a chosen beginning that is as telling.
        starts = ["^" + r["term"][1:k] for k in range(2, len(r["term"]) + 1)]
        if len(chosen) < most and not any(chosen.get(x, 0) >= r["share"] for x in starts):
            chosen[r["term"]] = r["share"]
    return list(chosen)


PATTERNS = ["two_hits", "four_hits", "dense", "early", "close", "shouted", "no_hit"]


class Votes:
    """Which voters speak on a text: one column per lexicon term, then ``PATTERNS``, then the number of hits (logarithm)."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.terms = terms
        self.automaton = ahocorasick.Automaton()
        by_text: dict[str, list[tuple[int, bool]]] = {}
        for k, term in enumerate(terms):
            by_text.setdefault(term[1:], []).append((k, term[0] == "="))
        for text, ids in by_text.items():
            self.automaton.add_word(text, (len(text), ids))
        if by_text:
            self.automaton.make_automaton()
        self.empty = not by_text

    def of(self, texts: list[str | None]) -> np.ndarray:
        k = len(self.terms)
        out = np.zeros((len(texts), k + len(PATTERNS) + 1), np.float32)
        for row, text in zip(out, texts):
            text = text or ""
            places = self._hits(text, row)
            n = len(places)
            row[k:k + 7] = (
                n >= 2, n >= 4, n > 0 and n * 500 >= len(text), n > 0 and places[0] < 400,
                any(b - a < 60 for a, b in zip(places, places[1:])), any(text[p:p + 4].isupper() for p in places), n == 0,
            )
            row[k + 7] = np.log1p(n)
        return out

    def _hits(self, text: str, row: np.ndarray) -> list[int]:
        places: set[int] = set()
        if self.empty or not text:
            return []
        low = text.lower()
        if len(low) != len(text):  # a letter whose lower case is longer: places are those of the lower-case text
            text = low
        for end, (size, ids) in self.automaton.iter(low):
            start = end - size + 1
            if start and low[start - 1].isalpha():
                continue
            whole = end + 1 == len(low) or not low[end + 1].isalpha()
            for k, word in ids:
                if whole or not word:
                    row[k] = 1
                    places.add(start)
        return sorted(places)


@dataclass
class LabelModel:
    """Class-conditional rates of every voter, and the weight that correlation leaves it."""

    prior: float = 0.0
    given_toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    given_clean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = np.log(self.given_toxic) - np.log(self.given_clean)
        no = np.log1p(-self.given_toxic) - np.log1p(-self.given_clean)
        odds = np.log(self.prior / (1 - self.prior)) + votes @ (self.weight * (yes - no)) + float(self.weight @ no)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 20) -> LabelModel:
    """Expectation maximisation on the votes alone.

    The labels say where to start, so that the first class is the toxic one, and how large the classes are. From then on a row's
    class is what its votes say; no label binds it.
    """
    n = len(votes)
    model = LabelModel(prior=float(np.clip(labels.mean(), 1e-4, 1 - 1e-4)))
    post = labels.astype(float)
    for _ in range(rounds):
        toxic, clean = post.sum(), n - post.sum()
        model.given_toxic = (votes.T @ post + 0.5) / (toxic + 1)
        model.given_clean = (votes.T @ (1 - post) + 0.5) / (clean + 1)
        # What is left of each vote when its class is known, and how it moves with the other votes.
        rest = votes - (post[:, None] * model.given_toxic + (1 - post)[:, None] * model.given_clean)
        cov = rest.T @ rest / n
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        tie = np.clip(cov / np.outer(sd, sd), 0, 1)
        tie[tie < 0.1] = 0
        np.fill_diagonal(tie, 1)
        model.weight = 1 / tie.sum(axis=1)
        new = model.posterior(votes)
        if np.abs(new - post).max() < 1e-4:
            break
        post = new
    return model


def fit_linear(features: np.ndarray, target: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the constant."""
    x = np.hstack([features, np.ones((len(features), 1))]).astype(float)
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (target - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class ToxicityModel:
    terms: list[str]
    weights: np.ndarray | None  # None: every text gets ``share``
    share: float


def draw_rows(docs: DataFrame, labels: DataFrame, most_rows: int) -> DataFrame:
    """(text, toxic) of at most ``most_rows`` labelled rows of ``docs``.

    Labels are drawn by a hash of doc_id. The bound is on documents: a label whose documents no longer fit is passed over, so
    ids that very many rows share never fill the sample.
    """
    known = labels.filter("toxic in (0, 1)").select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(most_rows)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    found = rows.select("doc_id").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic").agg(F.count("*").alias("n"))  # drawn: most_rows at most
    room, chosen = most_rows, []
    for r in found.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").collect():  # most_rows at most
        if r["n"] <= room:
            room -= r["n"]
            chosen.append((r["doc_id"], r["toxic"]))
    fitting = docs.sparkSession.createDataFrame(chosen, "doc_id long, toxic int")
    times = drawn.join(F.broadcast(fitting), ["doc_id", "toxic"], "left_semi")
    return rows.join(F.broadcast(times), "doc_id").select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, most_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """A model from at most ``most_rows`` rows of ``docs`` that have a label (doc_id, toxic)."""
    rows = draw_rows(docs, labels, most_rows)
    terms = choose_terms(rows)
    if not terms:
        share = rows.agg(F.avg("toxic")).first()[0]
        return ToxicityModel([], None, float(share or 0.0))
    table = _features(rows, terms, "toxic").collect()  # most_rows at most
    labels_ = np.array([r["keep"] for r in table], float)
    features = np.array([np.frombuffer(r["features"], np.float32) for r in table])
    votes = features[:, :-1].astype(float)
    return ToxicityModel(terms, fit_linear(features, fit_label_model(votes, labels_).posterior(votes)), float(labels_.mean()))


def _features(rows: DataFrame, terms: list[str], keep: str) -> DataFrame:
    ship_package(rows.sparkSession)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = Votes(terms)
        for batch in batches:
            found = votes.of(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in found], pa.binary()), batch.column(1)], ["features", "keep"])

    return rows.select("text", F.col(keep).cast("int").alias("keep")).mapInArrow(vote, "features binary, keep int")


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` (doc_id, text)."""
    ship_package(docs.sparkSession)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = Votes(model.terms)
        for batch in batches:
            if model.weights is None:
                p = np.full(batch.num_rows, model.share)
            else:
                p = 1 / (1 + np.exp(-np.clip(votes.of(batch.column(1).to_pylist()) @ model.weights[:-1] + model.weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rate, "doc_id long, score double")


def fold_of(doc_id: str, folds: int):
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % folds


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; labels of the held-out fold are never read for training."""
    docs = read_documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.filter(fold_of("doc_id", FOLDS) != HELD_OUT))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {"op7_toxicity": (op7_toxicity, None)}
