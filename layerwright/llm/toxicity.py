"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its byte n-grams (with word boundaries), each n-gram a vector out of a hashed table; a word's
vector is the average of its bag, a text's vector the average of its words, and a softmax on top gives the class.
Table and softmax are trained jointly in numpy on a bounded sample of labelled rows, so a misspelt or inflected
word that was never seen still gets the vectors of the n-grams it shares. Once trained the model is linear, so a
word adds one number to its text, and scoring is a look-up per word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import free_name, id_bucket, small_batches
from layerwright.session import stage

SAMPLE_PER_CLASS = 2400
NGRAMS = (4, 5, 6)
TABLE_BITS = 18
DIMENSIONS = 2
STEPS = 80
LEAST_TEXTS = 8
MOST_TEXTS = 0.3
LEAST_WORDS = 50
DECAY = 0.05
# A toxic word is about one in a hundred: this lifts its share of the average to the order of one.
GAIN = 100.0
RATES = (0.2, 0.05, 0.05)
# Added to the scale of a step, as a share of the largest: small gradients then make small steps.
FLOORS = (0.02, 0.0, 0.0)
_WORDS_KEPT = 300_000
_STRIP = b".,;:!?\"'()[]{}<>*#%&$|-_"


def words_of(text: str | None) -> list[bytes]:
    """Words, lower-cased A-Z, without punctuation at their ends."""
    if not text:
        return []
    return [w for w in (x.strip(_STRIP) for x in text.encode("utf-8", "surrogatepass").lower().split()) if w]


def ngram_ids(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The table rows of all n-grams of all words, and how many each word has."""
    sizes = np.array([len(w) for w in words], np.int64) + 2
    text = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(words) else np.empty(0, np.int64)
    ends = np.repeat(starts + sizes, sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(text))
    ids, owners = [], []
    for n in NGRAMS:
        fits = place + n <= ends
        hashed = np.full(len(text), n, np.uint64)
        for k in range(n):
            hashed = (hashed ^ text[np.minimum(place + k, len(text) - 1)]) * np.uint64(0x100000001B3)
            hashed ^= hashed >> np.uint64(31)
        ids.append((hashed[fits] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - TABLE_BITS)).astype(np.int32))
        owners.append(owner[fits])
    # The word itself is one more member of its bag.
    ids.append(np.fromiter((xxhash.xxh3_64_intdigest(w) >> (64 - TABLE_BITS) for w in words), np.int32, len(words)))
    owners.append(np.arange(len(words)))
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ids[order], np.bincount(owners, minlength=len(words))


def weighed(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words and their shares of the average: 1 + 0.2 * log2 of the count, so a run of one word is no majority.

    A text of few words is filled up with neutral ones, so that one odd word of three decides nothing.
    """
    counts = Counter(words)
    shares = 1 + 0.2 * np.log2(np.fromiter(counts.values(), np.float64, len(counts)))
    return list(counts), shares / max(shares.sum(), LEAST_WORDS)


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text and their shares of its average."""
    words, shares = weighed(words_of(text))
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    ids, per_word = ngram_ids(words)
    found, place = np.unique(ids, return_inverse=True)
    summed = np.bincount(place, weights=np.repeat(shares / per_word, per_word), minlength=len(found))
    return found.astype(np.int32), summed.astype(np.float32)


def descend(texts: list[str], labels: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """The table as one number per n-gram (its vector times the softmax weights of class 1 less class 0), and the bias.

    Gradient descent with momentum over all texts at once. Steps are scaled by the largest gradient, not one by
    one: n-grams that many texts of one class share move first, those of single texts hardly at all.
    """
    size = 1 << TABLE_BITS
    bags = [bag(text) for text in texts]
    full = np.array([len(ids) > 0 for ids, _ in bags], bool)
    y = np.asarray(labels, np.float64)[full] if len(bags) else np.empty(0)
    if len(set(y.tolist())) < 2:
        return np.zeros(size, np.float32), -4.0
    bags = [x for x in bags if len(x[0])]
    ids = np.concatenate([x[0] for x in bags])
    shares = np.concatenate([x[1] for x in bags])
    doc = np.repeat(np.arange(len(bags), dtype=np.int32), [len(x[0]) for x in bags])
    del bags
    # n-grams that few texts have say nothing about other texts, and those that very many texts of class 0 have
    # nothing about a class; their numbers stay zero.
    texts_with = np.bincount(ids, minlength=size)
    usual = np.bincount(ids[(y == 0)[doc]], minlength=size) > MOST_TEXTS * (y == 0).sum()
    least = min(LEAST_TEXTS, max(1, len(y) // 50))
    common = ((texts_with >= least) & ~usual)[ids]
    ids, shares, doc = ids[common], shares[common] * np.float32(GAIN), doc[common]
    used, ids = np.unique(ids, return_inverse=True)
    ids = ids.astype(np.int32)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.01, (len(used), DIMENSIONS)).astype(np.float32)
    softmax, bias = rng.normal(0, 1.0, (DIMENSIONS, 2)), np.zeros(2)
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    target = np.stack([1 - y, y], axis=1)
    values = [table, softmax, bias]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, STEPS + 1):
        hidden = np.stack(
            [np.bincount(doc, weights=table[ids, k] * shares, minlength=len(y)) for k in range(DIMENSIONS)], axis=1
        )
        logits = hidden @ softmax + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        wrong = (p - target) * weight[:, None]
        back = (wrong @ softmax.T).astype(np.float32)
        to_table = np.stack(
            [np.bincount(ids, weights=back[doc, k] * shares, minlength=len(used)) for k in range(DIMENSIONS)], axis=1
        )
        gradients = [to_table, hidden.T @ wrong, wrong.sum(axis=0)]
        for value, gradient, m, v, rate, floor in zip(values, gradients, first, second, RATES, FLOORS):
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient**2 - v)
            scale = np.sqrt(v / (1 - 0.99**step))
            value *= 1 - DECAY * rate
            value -= rate * (1 - (step - 1) / STEPS) * m / (1 - 0.9**step) / (scale + floor * scale.max() + 1e-12)
    numbers = np.zeros(size, np.float32)
    numbers[used] = table @ (softmax[:, 1] - softmax[:, 0]) * GAIN
    return numbers, float(bias[1] - bias[0])


def train(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """As ``descend``, on four fifths; the bias is then set on the last fifth, where false alarms cost double."""
    fifth = np.arange(len(texts)) % 5 == 0
    y = np.asarray(labels)
    if min((y[fifth] == 1).sum(), (y[fifth] == 0).sum()) < 5:
        return descend(texts, y)
    table, bias = descend([t for t, out in zip(texts, fifth) if not out], y[~fifth])
    scorer = Scorer(table, bias)
    logits, y = np.array([scorer.logit(t) for t, out in zip(texts, fifth) if out]), y[fifth]
    ordered = np.sort(logits)
    cuts = (ordered[1:] + ordered[:-1]) / 2
    alarms = np.array([(logits[y == 0] > c).mean() for c in cuts])
    missed = np.array([(logits[y == 1] <= c).mean() for c in cuts])
    cost = 2 * alarms + missed
    return table, bias - float(np.median(cuts[cost <= cost.min() + 1e-12]))


class Scorer:
    """Scores texts with a trained table; remembers the numbers of words, up to a bound."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias, self.known = table, bias, {}

    def learn(self, words: list[bytes]) -> None:
        if not words:
            return
        ids, per_word = ngram_ids(words)
        first = np.concatenate(([0], np.cumsum(per_word)[:-1]))
        self.known.update(zip(words, (np.add.reduceat(self.table[ids].astype(np.float64), first) / per_word).tolist()))

    def logit(self, text: str | None) -> float:
        words = words_of(text)
        if not words:
            return min(self.bias, -1.0)
        if len(self.known) > _WORDS_KEPT:
            self.known.clear()
        words, shares = weighed(words)
        self.learn([w for w in words if w not in self.known])
        return self.bias + float(shares @ np.fromiter(map(self.known.__getitem__, words), np.float64, len(words)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    eligible: Column | None = None,
    per_class: int = SAMPLE_PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[bytes, float]:
    """Train on at most ``per_class`` labelled rows of each class, the first by a hash of the id, in one task.

    ``eligible`` is a condition on the label rows' ``doc_id``. Null labels do not count; an id labelled more than
    once has its largest label.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .filter(eligible if eligible is not None else F.lit(True))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    marked = marked.join(known, "doc_id", "left_semi")
    order = [F.xxhash64(F.lit(11), "doc_id"), "doc_id"]
    chosen = [marked.filter(F.col("label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    # At most 2 * per_class ids.
    sample = F.broadcast(stage(chosen[0].unionByName(chosen[1]), "tox-sample"))
    bodies = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body"))

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
        table, bias = train(frame.body.tolist(), frame.label.to_numpy())
        return pd.DataFrame({"table": [table.tobytes()], "bias": [bias]})

    model = bodies.join(sample, "doc_id").withColumn("all", F.lit(1)).groupBy("all").applyInPandas(one, "table binary, bias double")
    trained = model.first()
    if trained is None:
        return np.zeros(1 << TABLE_BITS, np.float32).tobytes(), -4.0
    return bytes(trained.table), trained.bias


def score(docs: DataFrame, model: tuple[bytes, float], text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, 0 to 1: how likely label 1 is. Texts without words (null too) score low."""
    small_batches(docs.sparkSession)
    table, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(np.frombuffer(shared.value, np.float32), bias)
        for texts in batches:
            logits = np.array([scorer.logit(t) for t in texts], np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -40, 40))))

    return docs.withColumn(out, judged(F.col(text_col)))


HELD_OUT = 5


def learnable(doc_id: Column) -> Column:
    """Rows that may be learned from: crc32 of the id modulo 5 is not 0."""
    return id_bucket(doc_id, HELD_OUT) != 0


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 from 0.5). Other columns are not inputs.

    Null ids count as empty text in held_out. Without labels of both classes every text gets the same low score.
    """
    model = fit(docs, labels, "toxic", learnable(F.col("doc_id")))
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select(
        "doc_id",
        (id_bucket(F.col("doc_id"), HELD_OUT) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below 0.5, with all their columns."""
    name = free_name(docs.columns, "__score")
    scored = score(docs, fit(docs, labels, "toxic", learnable(F.col("doc_id"))), out=name)
    return scored.filter(F.col(name) < 0.5).drop(name)
