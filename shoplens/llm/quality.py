"""Quality classifier from weak labels.

Seven heuristic labellers each call a document good, bad, or nothing.  Votes are counted by pattern over all documents
(at most 3^7 patterns), and expectation-maximisation over these counts estimates how often each labeller gives each
vote for good and for bad documents, and the share of bad ones; no labels are read.  Each pattern then has a posterior.

The posteriors of a bounded sample (``TRAIN_ROWS`` documents, the first by a hash of doc_id and text) train a linear
scorer over hashed features: pairs of neighbouring character classes, and binned statistics of the words.  Every
document is scored over its whole text and goes if the scorer calls it bad, whatever the labellers say.  The scorer is
trained on texts of ``SOME_WORDS`` words or more; a shorter one goes only if the posterior of its votes and some labeller
call it bad, too.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import named, ship_code, staged

TRAIN_ROWS = 20_000
SLOTS = 1 << 12
KEEP_FROM = 0.5
FEW_WORDS = 6  # shorter texts are not judged
SPAN = 500  # words of a run whose variety is measured
SOME_WORDS = 20  # labellers that need a longer text say nothing below this
ROUNDS = 60

# Frequent function words of the languages, for one labeller.
FUNCTION_WORDS = frozenset(
    b"the of and to in is it that for on was as with be by are this or an at from "
    b"der die das und ist in zu den von mit ein eine nicht auf im auch "
    b"de la le les et des un une que en du est pour dans qui pas sur par "
    b"el los las y del que una por con para es se".split())

# Character classes: upper case, lower case and bytes beyond ASCII, digits, blanks, line ends; each other byte its own.
_CLASS = np.arange(256, dtype=np.int64)
_CLASS[128:] = ord("a")
_CLASS[ord("a"):ord("z") + 1] = ord("a")
_CLASS[ord("A"):ord("Z") + 1] = ord("A")
_CLASS[ord("0"):ord("9") + 1] = ord("0")
_CLASS[[9, 11, 12, 13]] = ord(" ")
_LETTER = (_CLASS == ord("a")) | (_CLASS == ord("A"))
_PLAIN = np.isin(np.arange(256), list(b" \n\t\r.,;:'\"-?()0123456789")) | _LETTER
LABELLERS = ("symbols", "capitals", "shouting", "variety", "repeats", "function words", "word length")


def variety(words: list[bytes]) -> float:
    """The lesser of the share of distinct words, as the mean over runs of ``SPAN`` words (of all words, if they are fewer;
    the last run ends with the text), and the share of distinct runs of five words in the whole text: neither falls with the
    length alone, as the share of distinct words would."""
    n, run, five = len(words), min(SPAN, len(words)), min(5, len(words))
    starts = [*range(0, n - run, run), n - run]
    near = sum(len(set(words[i:i + run])) for i in starts) / (len(starts) * run)
    return min(near, len(set(zip(*(words[i:] for i in range(five))))) / (n - five + 1))


def statistics(text: str) -> tuple[np.ndarray, int, np.ndarray]:
    """Seven measures (see ``LABELLERS``), the number of words, and the byte classes of a text."""
    data = text.encode()
    codes = np.frombuffer(data, np.uint8)
    hist = np.bincount(codes, minlength=256)
    words = data.lower().split()
    n = len(words)
    if not n:
        return np.zeros(7), 0, _CLASS[codes]
    letters = max(1, int(hist[_LETTER].sum()))
    lower = [w.strip(b".,") for w in words]
    return np.array([
        int(hist[~_PLAIN].sum() - hist[ord("!")]) / len(data),
        int(hist[ord("A"):ord("Z") + 1].sum()) / letters,
        int(hist[ord("!")]) / n,
        variety(lower),
        sum(map(eq, lower, lower[1:])) / n,
        sum(map(FUNCTION_WORDS.__contains__, lower)) / n,
        len(data) / n,
    ]), n, _CLASS[codes]


def votes(m: np.ndarray, n: int) -> list[int]:
    """Each labeller's vote: 2 good, 1 bad, 0 none."""
    if n < FEW_WORDS:
        return [0] * 7
    symbols, capitals, shouting, variety, repeats, function, length = m.tolist()

    def vote(good: bool, bad: bool) -> int:
        return 1 if bad else 2 if good else 0

    long = n >= SOME_WORDS
    return [
        vote(symbols < 0.005, symbols > 0.03),
        vote(capitals < 0.15, capitals > 0.5),
        vote(shouting < 0.02, shouting > 0.4),
        vote(long and variety > 0.3, long and variety < 0.12),
        vote(repeats < 0.05, repeats > 0.2),
        vote(long and function > 0.08, long and function < 0.005),
        vote(long and 4 < length < 12, long and (length < 3 or length > 20)),
    ]


def _slot(name: str) -> int:
    return xxhash.xxh32_intdigest(name, seed=3) % SLOTS


_PAIR_SLOT = (np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(52)).astype(np.int64) % SLOTS
_BINS = np.array([0.002, 0.01, 0.03, 0.08, 0.15, 0.3, 0.5, 0.8, 3, 6, 12, 20])
_BIN_SLOT = [[_slot(f"{name}>{b}") for b in range(len(_BINS) + 1)] for name in LABELLERS]


def features(m: np.ndarray, n: int, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: character-class pairs by the root of their share, and one slot per binned measure."""
    if not len(classes):
        return np.empty(0, np.int64), np.empty(0)
    pairs = np.bincount(_PAIR_SLOT[classes[:-1] * 256 + classes[1:]], minlength=SLOTS)
    slots = np.flatnonzero(pairs)
    values = np.sqrt(pairs[slots] / max(1, len(classes) - 1))
    if n < FEW_WORDS:
        return slots, values
    return np.concatenate([slots, [_BIN_SLOT[i][b] for i, b in enumerate(np.searchsorted(_BINS, m))]]), np.concatenate([values, np.full(7, 0.5)])


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over vote patterns (rows of 0, 1, 2) and their counts.

    Gives the posterior of good per pattern, the labellers' vote probabilities [class, labeller, vote] (class 0 bad, 1
    good) and the prior of good.  It begins with one bad vote outweighing good ones, as any one fault makes a document
    bad; a little of that belief stays in as pseudo-counts, so class 1 stays the good one.
    """
    if not len(patterns):
        return np.empty(0), np.full((2, 7, 3), 1 / 3), 0.5
    bad, good = (patterns == 1).sum(1), (patterns == 2).sum(1)
    post = np.where(bad > 0, 0.1, np.where(good > 0, 0.95, 0.9))
    total = counts.sum()
    prior, chance = 0.9, np.empty((2, patterns.shape[1], 3))
    belief = np.array([[0.4, 0.3, 0.3], [0.4, 0.01, 0.59]])  # for bad and good documents: no vote, bad, good
    for _ in range(rounds):
        for k, w in enumerate((counts * (1 - post), counts * post)):
            for v in range(3):
                chance[k, :, v] = ((patterns == v) * w[:, None]).sum(0) + belief[k, v] * 0.01 * total
            chance[k] /= chance[k].sum(1, keepdims=True)
        prior = float(np.clip((counts * post).sum() / total, 0.5, 0.99))
        at = np.arange(patterns.shape[1])
        logs = [np.log(chance[k][at, patterns]).sum(1) for k in (0, 1)]
        post = 1 / (1 + np.exp(np.clip(logs[0] + np.log(1 - prior) - logs[1] - np.log(prior), -50, 50)))
    return post, chance, prior


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, steps: int = 200, rate: float = 2.0, decay: float = 1e-5) -> np.ndarray:
    """Weights (the last is the bias) of a logistic scorer, by gradient descent with Adagrad; both classes weigh alike."""
    w, seen = np.zeros(SLOTS + 1), np.full(SLOTS + 1, 1e-6)
    if not rows:
        return w
    of = np.repeat(np.arange(len(rows)), [len(s) for s, _ in rows])
    slots, values = np.concatenate([s for s, _ in rows]), np.concatenate([v for _, v in rows])
    weight = target / max(target.sum(), 1) + (1 - target) / max((1 - target).sum(), 1)
    weight /= weight.sum()
    for _ in range(steps):
        z = np.bincount(of, values * w[slots], len(rows)) + w[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target)
        g = np.append(np.bincount(slots, values * error[of], SLOTS), error.sum()) + decay * w
        seen += g * g
        w -= rate * 0.1 * g / np.sqrt(seen)
    return w


def _votes_of(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            patterns = [sum(v * 3**i for i, v in enumerate(votes(*statistics(t or "")[:2]))) for t in batch.text]
            yield pd.DataFrame({"doc_id": batch.doc_id, "pick": batch.pick, "pattern": patterns})

    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("pick"), "text").mapInPandas(run, "doc_id long, pick long, pattern int")


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> dict:
    """The fitted classifier: weights, and what EM found (chance, prior, posterior by pattern)."""
    ship_code(docs.sparkSession)
    voted = staged(_votes_of(docs.select(F.col("doc_id").cast("long"), "text")), "quality-votes")
    found = voted.groupBy("pattern").count().orderBy("pattern").toPandas()  # at most 3^7 rows
    patterns = np.array([[p // 3**i % 3 for i in range(7)] for p in found.pattern], np.int64).reshape(-1, 7)
    post, chance, prior = estimate(patterns, found["count"].to_numpy(float))
    by_pattern = dict(zip(found.pattern.tolist(), post.tolist()))

    # the hash below which ``train_rows`` documents are expected; the fit itself takes that many at most
    total = int(found["count"].sum())
    limit = min(1.0, 1.2 * train_rows / max(total, 1))
    low = F.xxhash64("doc_id", "text") / F.lit(2.0**64) + F.lit(0.5) <= limit
    sample = docs.select(F.col("doc_id").cast("long"), "text").filter(low).withColumn("pick", F.xxhash64("doc_id", "text"))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, target = [], []
        for batch in batches:
            for text in batch.text:
                if len(rows) >= train_rows:
                    break
                m, n, classes = statistics(text or "")
                if n >= SOME_WORDS:
                    rows.append(features(m, n, classes))
                    target.append(by_pattern[sum(v * 3**i for i, v in enumerate(votes(m, n)))])
        yield pd.DataFrame({"weights": [fit_scorer(rows, np.array(target)).tobytes()]})

    weights = sample.repartition(1).sortWithinPartitions("pick", "doc_id").mapInPandas(fit, "weights binary").first()
    return {"weights": np.frombuffer(weights[0]) if weights else np.zeros(SLOTS + 1), "chance": chance, "prior": prior, "posterior": by_pattern}


def verdict(model: dict, keep_from: float = KEEP_FROM):
    """A column function from a text to its verdict: struct of score (0 to 1), posterior (of its votes) and keep."""
    weights, posterior = model["weights"], model["posterior"]

    @F.pandas_udf("score double, posterior double, keep boolean")
    def judged(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            m, n, classes = statistics(text or "")
            if n < FEW_WORDS:  # too little to judge by
                out.append((1.0, posterior.get(0, 0.5), True))
                continue
            slots, values = features(m, n, classes)
            s = float(1 / (1 + np.exp(-np.clip((values * weights[slots]).sum() + weights[-1], -50, 50))))
            cast = votes(m, n)
            weak = posterior.get(sum(v * 3**i for i, v in enumerate(cast)), 0.5)
            untrained = n < SOME_WORDS and (weak >= 0.5 or 1 not in cast)
            out.append((s, weak, s >= keep_from or untrained))
        return pd.DataFrame(out, columns=["score", "posterior", "keep"])

    return judged


def judge(docs: DataFrame, train_rows: int = TRAIN_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """Per row of ``docs``: ``row`` (its columns as a struct) and ``verdict`` (score, posterior, keep).

    Texts under ``FEW_WORDS`` words, null and empty ones among them, are kept with score 1.0: there is too little to
    judge them by.  Rows are judged one by one by their text, so repeated rows and shared or null ids get equal
    verdicts for equal texts.  An empty table gives no rows.  Votes and scores read whole texts.
    """
    judged = verdict(train(docs, train_rows), keep_from)
    return docs.select(F.struct(*named(docs)).alias("row"), judged(F.col("text")).alias("verdict"))
