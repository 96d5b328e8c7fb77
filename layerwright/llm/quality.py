"""Quality classifier: random Fourier features, ridge scores from summed normal equations, isotonic calibration.

Each text gives a few statistics. Cosines of random projections of them approximate a Gaussian kernel, and ridge
regression on those needs only sums over rows: every partition adds up its products, Spark adds up the
partitions, and the driver solves one small system. A last step makes the scores probabilities: the scores of
two folds, each from the other's model, are counted by bin and pooled until they rise.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import id_bucket, small_batches
from layerwright.session import stage

STATISTICS = [
    "log_words",
    "word_length",
    "long_words",
    "distinct_words",
    "repeated_next",
    "top_word",
    "upper",
    "digits",
    "marks",
    "odd_ends",
    "bars",
    "exclaims",
    "sentence_ends",
    "log_lines",
    "line_words",
    "repeated_lines",
    "capital_starts",
    "common_words",
]
FEATURES = 160
KERNEL_WIDTH = 3.0
RIDGE = 1e-3
# Features are kept as multiples of this, so that sums of their products are whole numbers and come out the same
# however the rows are dealt.
GRID = 4096
BINS = 2000
HELD_OUT = 3

_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_ODD_END = frozenset(b"#$%&*!|@~^+=_<>/\\")
_SENTENCE_END = frozenset(b".?")


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text; a text without words has zeros."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(raw)
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = bytes(w[-1] for w in words)
    repeated = sum(map(bytes.__eq__, words[1:], words[:-1]))
    count_of = lambda wanted: size - len(raw.translate(None, wanted))
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        float((lengths > 12).mean()),
        float(len(counts) / n),
        repeated / n,
        max(counts.values()) / n,
        count_of(_UPPER) / size,
        count_of(_DIGITS) / size,
        count_of(_MARKS) / size,
        sum(map(_ODD_END.__contains__, ends)) / n,
        raw.count(b"|") / n,
        raw.count(b"!") / n,
        sum(map(_SENTENCE_END.__contains__, ends)) / n,
        float(np.log1p(len(lines))),
        n / max(1, len(lines)) / 100,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(w[:1].isupper() for w in words) / n,
        sum(c for w, c in counts.items() if len(w) <= 3) / n,
    ]


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics (array of double) of each whole text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch.doc_id, "x": [statistics(t) for t in batch.body]})

    # Ids go as text: beside a null pandas would make them floats, which hold 53 bits.
    body = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("body"))
    return body.mapInPandas(run, "doc_id string, x array<double>").withColumn("doc_id", F.col("doc_id").cast("long"))


@dataclass
class Fourier:
    """Centre and scale of the statistics, and the random projection."""

    centre: np.ndarray
    scale: np.ndarray
    seed: int = 3

    def __call__(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        directions = rng.normal(0, 1 / KERNEL_WIDTH, (len(self.centre), FEATURES))
        phases = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        cosines = np.cos(z @ directions + phases)
        full = np.concatenate([cosines, np.clip(z, -4, 4) / 4, np.ones((len(z), 1))], axis=1)
        return np.rint(full * GRID) / GRID


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, len(STATISTICS)))


def _products(rows: DataFrame, features: Fourier) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Z'Z and Z'y per fold. A partition sends one row per entry of its sums, whatever its size."""
    width = FEATURES + len(STATISTICS) + 1
    upper = np.triu_indices(width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {}
        for batch in batches:
            z = np.rint(features(_stack(batch.x)) * GRID)
            for fold in np.unique(batch.fold):
                mine = (batch.fold == fold).to_numpy()
                zz, zy = sums.setdefault(int(fold), [np.zeros((width, width)), np.zeros(width)])
                zz += z[mine].T @ z[mine]
                zy += z[mine].T @ batch.label.to_numpy()[mine]
        for fold, (zz, zy) in sums.items():
            entries = np.concatenate([zz[upper], zy]).astype(np.int64)
            yield pd.DataFrame({"fold": fold, "entry": np.arange(len(entries)), "value": entries})

    sent = rows.mapInPandas(run, "fold int, entry int, value long")
    found = {}
    for fold, values in _by_fold(sent):
        zz = np.zeros((width, width))
        zz[upper] = values[: len(upper[0])]
        zz = zz + np.triu(zz, 1).T
        found[fold] = (zz / GRID**2, values[len(upper[0]) :] / GRID)
    return found


def _by_fold(sent: DataFrame) -> list[tuple[int, np.ndarray]]:
    """The summed entries, which are as many as the model has, whatever the input."""
    summed = sent.groupBy("fold", "entry").agg(F.sum("value").alias("value")).toPandas()
    return [
        (int(fold), rows.sort_values("entry")["value"].to_numpy(np.float64)) for fold, rows in summed.groupby("fold")
    ]


def _solve(parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    zz, zy = sum(p[0] for p in parts), sum(p[1] for p in parts)
    n = max(1.0, zz[-1, -1])
    return np.linalg.solve(zz / n + RIDGE * np.eye(len(zz)), zy / n)


def isotonic(values: np.ndarray, positives: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool neighbours until the shares rise. Returns the pools' mean values and shares, for interpolation.

    Pools of few rows are drawn to the middle a little, which may make a share fall, so those are pooled again.
    """
    first = _pooled(np.column_stack([values * counts, positives, counts]))
    second = _pooled(np.column_stack([first, first[:, 1] + 0.05, first[:, 2] + 0.1]), 3)
    return second[:, 0] / second[:, 2], second[:, 3] / second[:, 4]


def _pooled(sums: np.ndarray, at: int = 1) -> np.ndarray:
    """Rows added up with their neighbours until column ``at`` over the next rises from row to row."""
    pools: list[np.ndarray] = []
    for row in sums:
        pools.append(row)
        while len(pools) > 1 and pools[-2][at] * pools[-1][at + 1] >= pools[-1][at] * pools[-2][at + 1]:
            last = pools.pop()
            pools[-1] = pools[-1] + last
    return np.array(pools)


@dataclass
class QualityModel:
    features: Fourier
    weights: np.ndarray
    at: np.ndarray
    share: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.features(x) @ self.weights, self.at, self.share)


def learnable(doc_id: Column) -> Column:
    """Rows that may be learned from: crc32 of the id modulo 3 is not 1."""
    return id_bucket(doc_id, HELD_OUT) != 1


def fit(measured: DataFrame, labels: DataFrame, label_col: str = "quality") -> QualityModel | None:
    """Fit on all labelled rows that may be learned from; None when there are none.

    An id labelled more than once has its largest label; null labels do not count.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label"))
        .filter(F.col("label").isNotNull() & learnable(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    fold = (id_bucket(F.col("doc_id"), HELD_OUT) > 0).cast("int").alias("fold")
    rows = stage(measured.join(marked, "doc_id").select("x", "label", fold), "quality-rows")
    moments = [
        f(F.get("x", F.lit(i))).alias(f"{n}{i}") for i in range(len(STATISTICS)) for n, f in (("m", F.avg), ("s", F.stddev))
    ]
    found = rows.agg(F.count(F.lit(1)).alias("n"), *moments).first()
    if not found.n:
        return None
    centre = np.array([found[f"m{i}"] for i in range(len(STATISTICS))])
    spread = np.array([found[f"s{i}"] or 0.0 for i in range(len(STATISTICS))])
    spread = np.where(np.isfinite(spread) & (spread > 1e-6), spread, 1.0)
    # Rounded, so that the order of additions cannot show.
    features = Fourier(np.round(centre, 6), np.maximum(np.round(spread, 6), 1e-6))
    parts = _products(rows, features)
    weights = _solve(list(parts.values()))
    other = {f: _solve([parts[g]]) for f in parts for g in parts if g != f} or {f: weights for f in parts}

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = features(_stack(batch.x))
            raw = np.zeros(len(batch))
            for f, w in other.items():
                mine = (batch.fold == f).to_numpy()
                raw[mine] = z[mine] @ w
            bins = np.rint(np.clip((raw + 0.5) / 2, 0, 1) * BINS).astype(np.int32)
            yield pd.DataFrame({"bin": bins, "label": batch.label})

    # At most BINS + 1 rows.
    counted = (
        rows.mapInPandas(binned, "bin int, label double")
        .groupBy("bin")
        .agg(F.sum("label").alias("positives"), F.count(F.lit(1)).alias("n"))
        .toPandas()
        .sort_values("bin")
    )
    at, share = isotonic(
        counted.bin.to_numpy() / BINS * 2 - 0.5, counted.positives.to_numpy(), counted.n.to_numpy(np.float64)
    )
    return QualityModel(features, weights, at, share)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 from 0.5). Other columns are not inputs.

    Texts without words (null, empty) have all statistics zero and are scored like any other. Without a label that
    may be learned from every score is 0.5. Null ids count as empty text in held_out.
    """
    measured = stage(measure(docs), "quality-measured")
    model = fit(measured, labels)

    @F.pandas_udf("double")
    def judged(x: pd.Series) -> pd.Series:
        return pd.Series(model(_stack(x)) if model else np.full(len(x), 0.5))

    return measured.select(
        "doc_id", (id_bucket(F.col("doc_id"), HELD_OUT) == 1).alias("held_out"), judged(F.col("x")).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
