"""Toxicity by weak supervision. Voters vote on a learning sample of labelled and unlabelled documents: lexicons, patterns,
words that keep company with the lexicons' words, lexicons mined from the labels, and the annotators, who abstain on what
they haven't seen. A generative model, fitted by expectation and maximisation, estimates each voter's rates under either
class and the correlations between voters, by which voters that say the same share their weight. Its posteriors are the
soft targets of a linear classifier over hashed words and word beginnings, and that classifier alone scores every
document. Without any labels the method is the same: the annotators then abstain throughout.

Defined cases: a null or empty text scores as the bias says; without learning rows every text has the score that no
vote gives (RARE); an empty table gives no rows; where no voter ever speaks the bias alone is learned; labels of one class
only are votes like any others; repeated rows are scored each; rows of labels with null doc_id or label are ignored and of
several labels of a document the largest holds; texts are read whole at any length. Extra columns are ignored by
score_table and kept by drop_toxic."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ftrl
from .common import fold, kept, only, pick, table
from .quality_classifier import learn

DIMS = 1 << 18
#: Documented bounds: documents of the learning folds used for fitting, by a hash of their id: so many with a label, and
#: so many whether labelled or not.
TRAIN_ROWS, MORE_ROWS = 8000, 4000
THRESHOLD = 0.3
ALPHA, L1, EPOCHS = 0.3, 1.5, 5
CACHE = 200_000
BIAS = 0
#: So many different words of a text with the same beginning make a feature of their own.
SEVERAL = 3
MINED_VOTERS, COMPANY_VOTERS = 12, 3
#: Share of its documents, with a margin for chance, that a mined feature needs among labelled ones, a company feature
#: among those where a lexicon speaks.
LIKELY, COMPANY = 0.5, 0.75
WORD = re.compile(r"[^\W\d_]+")
#: Built-in lexicons, a voter each (fixed values).
LEXICONS = {
    "wits": "idiot idiots moron morons stupid dumb dumbass fool imbecile clown clowns cretin dimwit halfwit",
    "worth": "loser losers worthless pathetic useless scum trash garbage vermin filth lowlife parasite",
    "disgust": "disgusting repulsive vile gross sickening revolting creep freak pervert",
    "abuse": "bitch bastard asshole shit fuck fucking crap jerk whore slut wanker",
    "threat": "kill murder hang burn strangle punch hate",
    "german": "dummkopf trottel vollidiot depp arschloch scheisse abschaum widerlich erbärmlich versager",
    "french": "imbécile crétin connard connasse salope merde dégoûtant minable raclure ordure",
    "spanish": "idiota estúpido imbécil patético asqueroso escoria basura perdedor puta mierda",
}
INSULTS = {w for x in LEXICONS.values() for w in x.split()}
PATTERNS = [
    re.compile(r"\byou(?:'re| are)? (?:an? )?(?:\w+ )?(?:idiot|moron|loser|fool|clown)", re.I),
    re.compile(r"\bshut up\b|\bget lost\b|\bgo away\b", re.I),
    re.compile(r"\b(?:du|sie sind|tu es|vous êtes|eres) (?:ein |eine |un |une )?(?:idiot|idiota|trottel|crétin|imbécil)", re.I),
]
#: Chance of class 1 before any vote.
RARE = 0.05
#: What the label model holds of the annotators before it has seen any vote: their rates of a positive vote in class 0 and
#: 1, and how many votes that belief is worth.
RATES, TRUST = (0.02, 0.9), 50.0


def bucket(s: str, salt: int) -> int:
    return 1 + (zlib.crc32(s.encode("utf-8", "replace")) * 2654435761 + salt * 40503 >> 7) % (DIMS - 1)


class Words(dict):
    """Word -> its hashed features: itself and its beginnings of 4 to 6 letters."""

    def __missing__(self, word: str) -> tuple:
        if len(self) >= CACHE:
            self.clear()
        low = word.lower()
        self[word] = v = tuple({bucket(low, 1), *(bucket(low[:n], n) for n in range(4, 7))})
        return v


_words = kept(Words())


def indices(text: str | None) -> np.ndarray:
    """Distinct hashed features of a whole text, the bias first: words, their beginnings, and beginnings that several
    different words share."""
    words = set(WORD.findall(text or ""))
    if not words:
        return np.zeros(1, np.int32)
    found, n = np.unique(np.fromiter(chain.from_iterable(map(_words.__getitem__, words)), np.int64), return_counts=True)
    several = 1 + (found[n >= SEVERAL] * 2654435761 + 97 >> 5) % (DIMS - 1)
    return np.unique(np.concatenate([[BIAS], found, several])).astype(np.int32)


def example(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features, and in place of their values the votes of the built-in voters (0 or 1 each)."""
    words = {w.lower() for w in WORD.findall(text or "")}
    votes = [bool(words & set(x.split())) for x in LEXICONS.values()] + [bool(p.search(text or "")) for p in PATTERNS]
    return indices(text), np.array([*votes, len(words & INSULTS) > 1], np.float32)


def telling(rows, marked: np.ndarray, least: float) -> np.ndarray:
    """Features that, with a margin for chance, are in marked rows for more than `least` of their rows, strongest first."""
    n1, n = np.zeros(DIMS), np.zeros(DIMS)
    for (i, _), m in zip(rows, marked, strict=True):
        n[i] += 1
        if m:
            n1[i] += 1
    with np.errstate(divide="ignore", invalid="ignore"):
        p = n1 / n
        low = (p + 2 / n - 2 * np.sqrt(p * (1 - p) / n + 1 / n**2)) / (1 + 4 / n)  # Wilson's lower bound
    low[(n < 3) | ~np.isfinite(low)] = 0
    low[BIAS] = 0
    found = np.flatnonzero(low > least)
    return found[np.argsort(-low[found], kind="stable")]


def group_votes(rows, found: np.ndarray, voters: int) -> np.ndarray:
    """Votes of so many voters, each with an equal share of the features: 1 where a row has one of its features."""
    group = np.full(DIMS, voters)
    group[found] = np.arange(len(found)) * voters // max(1, len(found))
    out = np.zeros((len(rows), voters + 1))
    for k, (i, _) in enumerate(rows):
        out[k, group[i]] = 1
    return out[:, :voters]


def votes_of(rows, y: np.ndarray) -> np.ndarray:
    """A row of votes per document: built-in voters, company voters (features that go with the built-in lexicons' words),
    voters mined from the labels, and last the annotators: 1, 0, or not a number where they abstain."""
    built = np.array([b for _, b in rows], float)
    spoke, seen = built.any(1), ~np.isnan(y)
    company = group_votes(rows, telling(rows, spoke, COMPANY), COMPANY_VOTERS)
    some = [r for r, s in zip(rows, seen, strict=True) if s]
    mined = telling(some, y[seen] > 0, max(LIKELY, 1.5 * y[seen].mean())) if some and 0 < y[seen].mean() < 1 else np.zeros(0, int)
    return np.column_stack([built, company, group_votes(rows, mined, MINED_VOTERS), y])


def label_model(votes: np.ndarray, steps: int = 30) -> np.ndarray:
    """Posterior of class 1 per row, by expectation and maximisation over votes of 1, 0 or none (nan), the annotators' last.
    A voter's rates of a positive vote in either class are its accuracy; the correlations of the voters within classes say
    how much of its evidence is its own: of voters that always agree, each counts for its share."""
    seen = ~np.isnan(votes)
    v = np.where(seen, votes, 0.0)
    trust = np.zeros(v.shape[1])
    trust[-1] = TRUST
    said = v[:, :-1].sum(1)
    post = RARE + (1 - 2 * RARE) * np.where(seen[:, -1], v[:, -1], said / max(1.0, said.max()))
    for _ in range(steps):
        n1, n0 = post.sum(), (1 - post).sum()
        p1 = (post @ v + trust * RATES[1] + 0.5) / (post @ seen + trust + 1)
        p0 = ((1 - post) @ v + trust * RATES[0] + 0.5) / ((1 - post) @ seen + trust + 1)
        off = np.where(seen, v - (post[:, None] * p1 + (1 - post)[:, None] * p0), 0.0)
        both = seen.T.astype(float) @ seen
        cov = off.T @ off / np.maximum(both, 1)
        spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        share = 1 / np.maximum(0, cov / np.outer(spread, spread)).sum(1).clip(1)  # 1 with itself
        share[-1] = 1  # others are mined from the annotators' votes, not they from others
        logit = np.log(max(n1, 1e-9) / max(n0, 1e-9)) + v @ (share * np.log(p1 / p0)) + (seen - v) @ (share * np.log((1 - p1) / (1 - p0)))
        new = np.clip(ftrl.sigmoid(logit), 1e-4, 1 - 1e-4)
        done = np.abs(new - post).max() < 1e-4
        post = new
        if done:
            break
    return post


def fit(rows, y) -> np.ndarray:
    """rows: (indices, built-in votes); y: labels, None where there is none."""
    y = np.array([np.nan if x is None else x for x in y], float)
    if not len(y):
        w = np.zeros(DIMS, np.float32)
        w[BIAS] = np.log(RARE / (1 - RARE))
        return w
    post = label_model(votes_of(rows, y))
    data = [(i, np.ones(len(i), np.float32)) for i, _ in rows]
    # Evidence only adds up: what a clean word says must not outweigh an insult in a long text.
    return ftrl.fit(data, post, np.ones(len(y)), DIMS, alpha=ALPHA, l1=L1, epochs=EPOCHS, free=[BIAS])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, more: int = MORE_ROWS) -> np.ndarray:
    got = learn(docs, labels, "toxic", 4, 2, rows, example, more)
    return fit([r[2:] for r in got], [r[1] for r in got])


def score_texts(texts, w: np.ndarray) -> np.ndarray:
    return ftrl.sigmoid(np.array([w[indices(t)].sum(dtype=np.float64) for t in texts], float))


def scorer(weights: np.ndarray):
    """A Column function text -> score; the weights are 1 MB, whatever the input."""
    raw = weights.tobytes()

    @F.pandas_udf("double")
    def score(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        only(_words)
        w = np.frombuffer(raw, np.float32)
        for texts in it:
            yield pd.Series(score_texts(texts.tolist(), w), index=texts.index, dtype="float64")

    return score


def score_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    score = scorer(train(docs, labels))
    d = pick(docs, doc_id="bigint", text="string")
    return d.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), score("text").alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that the classifier doesn't hold toxic, with all their columns."""
    score = scorer(train(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(docs["text"].cast("string")) < THRESHOLD)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
