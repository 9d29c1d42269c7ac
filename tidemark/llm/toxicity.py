"""Toxicity by non-negative positive-unlabelled learning on hashed words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text

#: Bits of a word's number, words a classifier may use, labelled rows of each label and unlabelled rows it is fitted on.
BITS, WORDS, LABELLED, UNLABELLED = 20, 4096, 5_000, 10_000
#: Beginnings of words, in bytes, that are features beside whole words.
CUTS = (4, 5, 6)
ROUNDS, RATE, DECAY = 300, 0.1, 1e-3


def held_out(id_: Column) -> Column:
    """Rows kept from training: a checksum of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words_of(texts: pa.Array, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers of words and their beginnings in each text, and the number of the text they are in.

    With ``used`` (a flag for every number) only those.
    """
    kinds, at = text.beginnings(*text.buffer(texts), text.NOT_LETTER, CUTS)
    owner, both = np.repeat(np.arange(len(texts)), np.diff(at)), []
    for salt, hashes in enumerate(kinds):
        number = (text.mix(hashes + np.uint64(salt)) >> np.uint64(64 - BITS)).astype(np.int64)
        keep = slice(None) if used is None else used[number]
        both.append(owner[keep] << BITS | number[keep])
    both = np.unique(np.concatenate(both))
    return both & ((1 << BITS) - 1), both >> BITS


@dataclass
class Model:
    words: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS)
        out[self.words] = self.weights
        return out

    def margin(self, sums: np.ndarray) -> np.ndarray:
        return self.slope * (sums + self.bias) + self.shift


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def chosen_words(word: np.ndarray, owner: np.ndarray, positive: np.ndarray, prior: float, most: int = WORDS) -> np.ndarray:
    """Words that by themselves make a text rather toxic than not, the clearest by likelihood ratio.

    A text with the word is toxic with probability prior x its share of positive texts / its
    share of unlabelled ones.
    """
    n_p, n_u = positive.sum(), (~positive).sum()
    p = np.bincount(word[positive[owner]], minlength=1 << BITS)
    u = np.bincount(word[~positive[owner]], minlength=1 << BITS)
    a, b = (p + 0.5) / (n_p + 1), (u + 0.5) / (n_u + 1)
    score = p * np.log(a / b) + (n_p - p) * np.log((1 - a) / (1 - b))
    score[(p < 3) | (prior * a < 0.5 * b)] = 0
    best = np.argsort(-score, kind="stable")[:most]
    return np.sort(best[score[best] > 6])


def fit_pu(word: np.ndarray, owner: np.ndarray, positive: np.ndarray, prior: float) -> Model:
    """Linear classifier by the non-negative risk estimator with the sigmoid loss (Kiryo et al., 2017).

    Risk: prior x loss of positives as toxic + max(0, loss of unlabelled as clean - prior x
    loss of positives as clean). Where the bracket falls below zero, the step goes up its
    gradient instead. Full-batch Adam over presence of the chosen words.
    """
    columns = chosen_words(word, owner, positive, prior)
    at = np.full(1 << BITS, -1)
    at[columns] = np.arange(len(columns))
    inside = at[word] >= 0
    col, row = at[word[inside]], owner[inside]
    n = len(positive)
    p, u = np.flatnonzero(positive), np.flatnonzero(~positive)
    theta, bias = np.zeros(len(columns) + 1), -2.0
    theta[-1] = bias
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        z = np.bincount(row, theta[col], n) + theta[-1]
        s = _sigmoid(z)
        slope = s * (1 - s)  # of the loss as clean; minus that of the loss as toxic
        clean = s[u].mean() - prior * s[p].mean()
        g = np.zeros(n)
        if clean >= 0:
            g[p] = -2 * prior * slope[p] / len(p)
            g[u] = slope[u] / len(u)
        else:
            g[u] = -slope[u] / len(u)
            g[p] = prior * slope[p] / len(p)
        grad = np.append(np.bincount(col, g[row], len(columns)), g.sum())
        grad[:-1] += DECAY * prior * theta[:-1] / 10
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        np.maximum(theta[:-1], 0, out=theta[:-1])  # every chosen word speaks for toxicity
    return Model(columns, theta[:-1], float(theta[-1]))


def calibrate(model: Model, word: np.ndarray, owner: np.ndarray, label: np.ndarray) -> Model:
    """Slope and shift of the margin by logistic regression on labelled training rows, so that scores are probabilities."""
    x = np.bincount(owner, model.table()[word], len(label)) + model.bias
    target = np.where(label == 1, (label.sum() + 1) / (label.sum() + 2), 1 / ((label == 0).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton
        s = _sigmoid(a * x + b)
        r, h = s - target, np.maximum(s * (1 - s), 1e-9)
        grad = np.array([(r * x).sum() + 1e-3 * (a - 1), r.sum() + 1e-3 * b])
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    model.slope, model.shift = float(max(a, 1e-3)), float(b)
    return model


def bound(want: int, there: int) -> int:
    """The 64-bit hash up to which about ``want`` of ``there`` rows have theirs; at least one in 2^64."""
    return min((1 << 63) - 1, (want << 64) // max(1, there) - (1 << 63))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> Model:
    """The classifier, from rows that are not held out.

    Fitted on about ``labelled`` rows of each label and ``unlabelled`` other rows at most,
    chosen by a hash of the id; of several labels of an id the highest counts, null labels
    and ids are left out. The class prior is the share of toxic labels among all training
    labels. Without any toxic label every score is the prior's.
    """
    known = labels.where(labels[label_col].isNotNull() & labels[id_col].isNotNull()).groupBy(labels[id_col].cast("long").alias("id")) \
        .agg((F.max(label_col) > 0).cast("int").alias("label")).where(~held_out(F.col("id")))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    drawn = lambda want, there: F.xxhash64("id", F.lit(7)) <= F.lit(bound(want, there))
    picked = known.where(F.when(F.col("label") == 1, drawn(labelled, counts.get(1, 0))).otherwise(drawn(labelled, counts.get(0, 0))))
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    # at most about 2 x labelled rows of 12 bytes
    joined = texts.join(F.broadcast(picked), "id", "left").where(F.col("id").isNotNull() & ~held_out(F.col("id")))
    rows = joined.where(F.col("label").isNotNull() | drawn(unlabelled, docs.count()))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.chunks(batch):
                word, owner = words_of(part.column("text"))
                ends = np.searchsorted(owner, np.arange(len(part) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(word, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("label"), lists], ["label", "words"])

    got = rows.select("label", "text").mapInArrow(gather, "label int, words array<int>").toArrow()
    label = np.asarray(got.column("label").fill_null(-1).combine_chunks())
    lists = got.column("words").combine_chunks()
    word = np.asarray(lists.flatten()) if len(got) else np.empty(0, np.int32)
    owner = np.repeat(np.arange(len(got), dtype=np.int32), np.asarray(lists.value_lengths(), np.int64)) if len(got) else word
    if not (label == 1).any():
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log((prior + 1e-3) / (1 - prior + 1e-3))))
    # positives are confirmed; all other rows, whatever their label, are unlabelled
    model = fit_pu(word, owner, label == 1, min(max(prior, 0.01), 0.9))
    told = label >= 0
    number = np.cumsum(told) - 1
    use = told[owner]
    return calibrate(model, word[use], number[owner[use]], label[told])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): probability of toxicity of every whole text; only the text is an input.

    Null and empty texts get the score of a text without known words. Null ids and
    repeated rows stay, other columns are not read, an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value.table()
        used = table != 0
        for batch in batches:
            for part in text.chunks(batch):
                word, owner = words_of(part.column("text"), used)
                sums = np.bincount(owner, table[word], len(part))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(_sigmoid(sent.value.margin(sums)))], ["id", "score"])

    narrow = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, "id long, score double")
