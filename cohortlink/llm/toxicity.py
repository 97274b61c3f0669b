"""Operator 4: toxicity by weak supervision.

Many weak *voters* look at a text: one per lexicon word, one per word that the
labelled rows tie to toxicity, and a few patterns.  A generative label model
(two classes, voters independent given the class except for groups of
correlated ones) estimates by expectation maximisation how often each voter
fires in either class; voters whose residuals correlate share one vote.  Its
posteriors, not the labels, train a linear classifier on word features, which
scores every document.

Labels are learnt only from rows whose crc32(doc_id as text) mod 4 is not 2,
and from at most FIT_ROWS of them (smallest hash of the id): the model is fit
on the driver on those rows' votes and features.  Scoring is row-wise over
whole texts, with a model of bounded size; labels, lang, source and doc_id are
never inputs of a score.

Defined cases: null or empty text has no words and gets the score of a text
without features; without labelled rows the lexicon's starting values stand;
a null id is not held out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlink.llm.common import materialise, narrow, prepare

FIT_ROWS = 20_000
#: words of the classifier, and documents of the sample a word must occur in
VOCABULARY, LEAST_DOCS = 4000, 5
#: share of toxic rows and support from which a word becomes a voter of its own; number of such voters
LEARNT_PRECISION, LEARNT_SUPPORT, LEARNT_MOST = 0.8, 8, 100
THRESHOLD = 0.3
#: residual correlation from which two voters count as one
CORRELATED = 0.5

# Words that insult or threaten.
LEXICON = """
abuse arsehole asshole bastard bigot bitch brainless clown coward creep cretin crap cunt damn degenerate despicable
dickhead dimwit disgusting dumb dumbass filth filthy fool freak fuck fucking garbage halfwit hateful idiot idiotic
ignorant imbecile jackass jerk kill liar lowlife loser lunatic moron moronic motherfucker nasty pathetic pig piss
pervert prick psycho puke rat repulsive retard rubbish savage scum scumbag shit shithead shut sicko slut stupid
subhuman suck sucks swine thug trash twat ugly useless vermin vile vomit wanker weirdo whore worthless wretch
""".split()
# Patterns that often go with insults.
PATTERN_VOTERS = {
    "you_are": re.compile(r"\b(?:you are|you're|u r)\s+(?:such\s+)?(?:an?\s+)?(?:" + "|".join(LEXICON) + r")\b"),
    "threat": re.compile(r"\b(?:kill|hurt|destroy|hunt) (?:you|them|him|her)\b|\bgo to hell\b|\bshut up\b|\bi hate\b"),
    "masked": re.compile(r"\b[a-z][*#@$%]{2,}[a-z]?\b"),
    "bangs": re.compile(r"!{3,}"),
}
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    """Distinct lower-case words (letters only) of a whole text."""
    out: set[str] = set()
    for chunk in set(text.lower().split()):
        if chunk.isalpha():
            out.add(chunk)
        else:
            out.update(_WORD.findall(chunk))
    return out


def patterns_of(text: str) -> list[str]:
    low = text.lower()
    return [f"pattern {k}" for k, p in PATTERN_VOTERS.items() if p.search(low)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


# --- label model -----------------------------------------------------------------------------

def label_model(votes: np.ndarray, start: np.ndarray, prior: float, rounds: int = 50):
    """Posterior of class 1 per row of a 0/1 vote matrix, and the rates P(fires | class).

    ``start``: first guess of the rates, two rows (class 0, class 1); ``prior``: share of class 1.
    """
    rate, share = np.clip(start, 1e-4, 1 - 1e-4), np.ones(votes.shape[1])
    post = _posterior(votes, rate, prior, share)
    for _ in range(rounds):
        weight = np.stack([1 - post, post])
        # two rows' worth of the first guess keeps rare voters from drifting
        rate = np.clip((weight @ votes + 2 * start) / (weight.sum(1, keepdims=True) + 2), 1e-4, 1 - 1e-4)
        prior = float(np.clip(post.mean(), 1e-4, 1 - 1e-4))
        share = 1 / correlated_groups(votes, rate, post)
        new = _posterior(votes, rate, prior, share)
        done = np.abs(new - post).max() < 1e-6
        post = new
        if done:
            break
    return post, rate


def _posterior(votes, rate, prior, share):
    fires = np.log(rate[1] / rate[0]) * share
    silent = np.log((1 - rate[1]) / (1 - rate[0])) * share
    odds = np.log(prior / (1 - prior)) + votes @ fires + (1 - votes) @ silent
    return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def correlated_groups(votes: np.ndarray, rate: np.ndarray, post: np.ndarray) -> np.ndarray:
    """Size of each voter's group; voters whose residuals (vote minus its expected value) correlate are one group."""
    rest = votes - (np.outer(1 - post, rate[0]) + np.outer(post, rate[1]))
    norm = np.sqrt((rest ** 2).sum(0))
    norm[norm == 0] = 1
    near = (rest.T @ rest) / np.outer(norm, norm) > CORRELATED
    group = np.arange(votes.shape[1])
    for i, j in np.argwhere(np.triu(near, 1)):
        group[group == group[j]] = group[i]
    return np.bincount(group, minlength=len(group))[group].astype(float)


def linear_classifier(rows: list[np.ndarray], n: int, target: np.ndarray, rounds: int = 300, penalty: float = 1e-4,
                      rate: float = 0.5) -> np.ndarray:
    """Logistic regression on sparse 0/1 features by gradient steps with per-feature scaling; last weight: bias."""
    at = np.concatenate([np.append(r, n) for r in rows]).astype(np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    w, seen = np.zeros(n + 1), np.full(n + 1, 1e-8)
    # the rarer class weighs as much as the other, so that a score near 0.5 means undecided
    weight = np.where(target > 0.5, 0.5 / max(target.mean(), 1e-3), 0.5 / max(1 - target.mean(), 1e-3))
    weight = np.minimum(weight, 20)
    for _ in range(rounds):
        score = 1 / (1 + np.exp(-np.clip(np.bincount(of, w[at], len(rows)), -40, 40)))
        grad = np.bincount(at, ((score - target) * weight)[of], n + 1) / len(rows) + penalty * w
        seen += grad ** 2
        w -= rate * grad / np.sqrt(seen)
    return w


# --- fitting and scoring ---------------------------------------------------------------------

@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str) -> float:
        odds = self.bias + sum(self.weights[w] for w in words_of(text) & self.weights.keys())
        odds += sum(self.weights.get(p, 0.0) for p in patterns_of(text))
        return float(1 / (1 + np.exp(-np.clip(odds, -40, 40))))


def fit_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, features (words and patterns) of at most FIT_ROWS labelled rows that are not held out."""
    few = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).dropDuplicates(["doc_id"])
    few = few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)

    def run(batches):
        for b in batches:
            f = [sorted(words_of(t)) + patterns_of(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(f, pa.list_(pa.string()))],
                                             ["doc_id", "toxic", "features"])
    # at most FIT_ROWS rows of two numbers: a proven bound
    return materialise(docs.join(F.broadcast(few), "doc_id").select("doc_id", "text", "toxic").mapInArrow(
        run, "doc_id long, toxic int, features array<string>"), "fit_sample")


def _encoded(batches, place: dict[str, int]):
    for b in batches:
        f = [sorted(place[w] for w in ws if w in place) for ws in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(f, pa.list_(pa.int32()))], ["doc_id", "toxic", "f"])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    sample = fit_sample(docs, labels)
    words = sample.select("toxic", F.explode("features").alias("word"))
    count = words.groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
    learnt = [r.word for r in count.where(
        (F.col("t") >= LEARNT_SUPPORT) & (F.col("t") >= LEARNT_PRECISION * F.col("n"))).orderBy(
        F.desc("t"), "word").limit(LEARNT_MOST).collect()]
    vocabulary = [r.word for r in count.where(f"n >= {LEAST_DOCS}").orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()]
    voters = list(dict.fromkeys([*LEXICON, *(f"pattern {p}" for p in PATTERN_VOTERS), *learnt]))
    features = list(dict.fromkeys([*voters, *vocabulary]))
    place = {f: k for k, f in enumerate(features)}
    got = sample.mapInArrow(lambda it: _encoded(it, place), "doc_id long, toxic int, f array<int>").orderBy("doc_id").collect()
    if not got:
        return Model({w: 3.0 for w in LEXICON}, -2.0)
    rows = [np.array(r.f, np.int64) for r in got]
    votes = np.zeros((len(rows), len(voters)))
    for k, r in enumerate(rows):
        votes[k, r[r < len(voters)]] = 1
    toxic = np.array([r.toxic for r in got], float)
    prior = float(np.clip(toxic.mean(), 0.01, 0.5))
    start = np.stack([((1 - toxic) @ votes + 0.01) / ((1 - toxic).sum() + 2), (toxic @ votes + 0.2) / (toxic.sum() + 2)])
    post, _ = label_model(votes, start, prior)
    w = linear_classifier(rows, len(features), post)
    return Model({f: float(w[k]) for f, k in place.items()}, float(w[-1]))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    prepare(docs.sparkSession)
    docs = narrow(docs, id_col, text_col)
    model = fit(docs, labels)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([model.score(t) for t in b.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])
    return docs.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
