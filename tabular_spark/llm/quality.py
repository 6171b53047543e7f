"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are a few shares and counts, computed over the whole text. The model adds up,
in log odds, one lookup table per feature and one per chosen pair of features. Tables are learned
by cyclic boosting: round after round, each feature in turn gets a small step along a shallow
tree fitted to what is left to explain; then pairs, chosen by how much a coarse grid of them
explains of the rest, are boosted in the same way. Scoring is a search for each value's bin and a
sum of table entries.

The model is fitted on the driver from a bounded sample of labelled rows, ``MOST_LABELLED``; all
documents are scored on the executors.

Cases: a null text counts as empty and is scored like any other; null labels are left out and a
document labelled more than once counts by its mean label; with labels of one class or none the
score is that class (or 0.5) everywhere; repeated rows stay; extra columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabular_spark.llm.common import stored, text_of

FEATURES = ("log_words", "repeated", "bars", "signs", "shouts", "upper", "digits", "punctuation", "word_length", "lines")
#: Labelled rows that the model is fitted on, at most: those whose ids have the smallest hashes.
MOST_LABELLED = 20_000
BINS, GRID, PAIRS, ROUNDS, RATE, LEAVES, LEAST_LEAF = 64, 8, 5, 150, 0.2, 4, 20
THRESHOLD = 0.3
CHUNK = 4 << 20


def features(texts: list[bytes]):
    """One row of ``FEATURES`` for each UTF-8 text."""
    import numpy as np

    out = np.zeros((len(texts), len(FEATURES)))
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum([len(x) + 1 for x in texts])
    starts = ends - [len(x) + 1 for x in texts]

    def per_text(mask):  # sums per text; every text has its closing space, so none is empty
        return np.add.reduceat(mask.astype(np.int64), starts)

    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    first = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    last = np.flatnonzero(space & np.concatenate(([False], ~space[:-1])))
    lower, upper = (raw >= 97) & (raw <= 122), (raw >= 65) & (raw <= 90)
    of = np.searchsorted(ends, first, "right")  # the text of each word
    words = np.bincount(of, minlength=len(texts))
    size = np.maximum(ends - starts - 1, 1)
    some = np.maximum(words, 1)
    if len(first):
        code = np.random.default_rng(7).integers(1, 1 << 62, 256, dtype=np.uint64)[raw]
        place = np.arange(len(raw)) - np.repeat(first, np.diff(np.append(first, len(raw)))) if first[0] == 0 else np.concatenate((np.zeros(first[0], np.int64), np.arange(first[0], len(raw)) - np.repeat(first, np.diff(np.append(first, len(raw))))))
        code = np.where(space, 0, code * (2 * place.astype(np.uint64) + 1))
        hashes = np.add.reduceat(code, first)
        same = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        out[:, 1] = np.bincount(of[1:], same, len(texts)) / some
        out[:, 8] = np.bincount(of, last - first, len(texts)) / some
    sign = np.isin(raw, np.frombuffer(b"*&%$#@~^", np.uint8))
    point = (raw > 32) & (raw < 127) & ~lower & ~upper & ~((raw >= 48) & (raw <= 57))
    out[:, 0] = np.log1p(words)
    out[:, 2] = per_text(raw == 124) / some
    out[:, 3] = per_text(sign) / some
    out[:, 4] = per_text(raw == 33) / some
    out[:, 5] = per_text(upper) / np.maximum(per_text(upper | lower), 1)
    out[:, 6] = per_text((raw >= 48) & (raw <= 57)) / size
    out[:, 7] = per_text(point) / size
    out[:, 9] = per_text(raw == 10) / some
    return out


def feature_rows(column) -> Any:
    """Features of an Arrow or pandas column of texts, a few megabytes at a time."""
    import numpy as np

    rows, run, size = [], [], 0
    for text in column:
        run.append((text or "").encode())
        size += len(run[-1])
        if size >= CHUNK:
            rows.append(features(run))
            run, size = [], 0
    if run:
        rows.append(features(run))
    return np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))


@dataclass
class AdditiveModel:
    """Edges and table per feature; for each pair its two features, their edges and a grid."""

    intercept: float
    edges: list[Any] = field(default_factory=list)
    tables: list[Any] = field(default_factory=list)
    pairs: list[tuple[int, int, Any, Any, Any]] = field(default_factory=list)

    def score(self, x) -> Any:
        import numpy as np

        z = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            z += table[np.searchsorted(edges, x[:, j], "right")]
        for a, b, edges_a, edges_b, grid in self.pairs:
            z += grid[np.searchsorted(edges_a, x[:, a], "right"), np.searchsorted(edges_b, x[:, b], "right")]
        return 1 / (1 + np.exp(-z))


def best_cut(gradient, weight, count, start: int, end: int):
    """(gain, cut) of the best split of the bins start..end-1, or None."""
    import numpy as np

    if end - start < 2:
        return None
    g, h, n = (np.cumsum(x[start:end]) for x in (gradient, weight, count))
    ok = (n[:-1] >= LEAST_LEAF) & (n[-1] - n[:-1] >= LEAST_LEAF)
    if not ok.any():
        return None
    gain = g[:-1] ** 2 / (h[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1) - g[-1] ** 2 / (h[-1] + 1)
    at = int(np.argmax(np.where(ok, gain, -1.0)))
    return float(gain[at]), start + at + 1


def shallow_tree(gradient, weight, count):
    """A step for each bin: a tree of at most ``LEAVES`` leaves, grown where it gains most."""
    import numpy as np

    leaves = [(0, len(gradient))]
    while len(leaves) < LEAVES:
        cuts = [(c, leaf) for leaf in leaves if (c := best_cut(gradient, weight, count, *leaf)) and c[0] > 1e-9]
        if not cuts:
            break
        (_, at), (start, end) = max(cuts)
        leaves.remove((start, end))
        leaves += [(start, at), (at, end)]
    step = np.zeros(len(gradient))
    for start, end in leaves:
        step[start:end] = gradient[start:end].sum() / (weight[start:end].sum() + 1)
    return step


def quadrants(gradient, weight):
    """A step for each cell of a grid: the best cut on each axis, four regions."""
    import numpy as np

    cum = [np.cumsum(np.cumsum(x, 0), 1) for x in (gradient, weight)]
    best, found = 0.0, None
    for i in range(gradient.shape[0] - 1):
        for j in range(gradient.shape[1] - 1):
            gain = 0.0
            steps = np.zeros((2, 2))
            for a in (0, 1):
                for b in (0, 1):
                    g, h = ((c[i, j] if (a, b) == (0, 0) else c[-1, j] - c[i, j] if (a, b) == (1, 0) else c[i, -1] - c[i, j] if (a, b) == (0, 1) else c[-1, -1] - c[i, -1] - c[-1, j] + c[i, j]) for c in cum)
                    gain += g * g / (h + 1)
                    steps[a, b] = g / (h + 1)
            if gain > best:
                best, found = gain, (i, j, steps)
    step = np.zeros(gradient.shape)
    if found:
        i, j, steps = found
        step[: i + 1, : j + 1], step[i + 1 :, : j + 1], step[: i + 1, j + 1 :], step[i + 1 :, j + 1 :] = steps[0, 0], steps[1, 0], steps[0, 1], steps[1, 1]
    return best, step


def cut_points(x, bins: int):
    import numpy as np

    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x, y) -> AdditiveModel:
    """The model of rows ``x`` with labels ``y`` in 0 to 1."""
    import numpy as np

    if not len(y):
        return AdditiveModel(0.0)
    mean = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
    model = AdditiveModel(float(np.log(mean / (1 - mean))))
    if y.min() == y.max():
        return model
    z = np.full(len(y), model.intercept)
    model.edges = [cut_points(x[:, j], BINS) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]
    for _ in range(ROUNDS):
        for b, table, count in zip(bins, model.tables, counts):
            p = 1 / (1 + np.exp(-z))
            step = RATE * shallow_tree(np.bincount(b, y - p, len(table)), np.bincount(b, p * (1 - p), len(table)), count)
            table += step
            z += step[b]
    coarse = [cut_points(x[:, j], GRID) for j in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]

    def grids(a: int, b: int):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        at, p = cells[a] * shape[1] + cells[b], 1 / (1 + np.exp(-z))
        return at, [np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p))]

    ranking = sorted(((quadrants(*grids(a, b)[1])[0], a, b) for a in range(x.shape[1]) for b in range(a)), reverse=True)
    chosen = [(a, b, np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for _, a, b in ranking[:PAIRS]]
    for _ in range(ROUNDS // 5):
        for a, b, grid in chosen:
            at, sums = grids(a, b)
            step = RATE * quadrants(*sums)[1]
            grid += step
            z += step.reshape(-1)[at]
    model.pairs = [(a, b, coarse[a], coarse[b], grid) for a, b, grid in chosen]
    return model


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, features) of every document."""
    slim = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = feature_rows(x.as_py() for x in batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(rows), pa.list_(pa.float64()))], ["doc_id", "features"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, features array<double>")


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def chosen(labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, label) of at most ``most`` labelled ids, those of the least hashes, held-out ids left out.

    A threshold of the hash leaves somewhat more than ``most`` rows to sort, whatever the number of labels and tasks.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("doc_id")).agg(F.avg(label_col).alias("label"))
    known, order = stored(known, "quality-labels"), F.xxhash64("doc_id")
    if (n := known.count()) > 2 * most:
        few = known.where(F.pmod(order, F.lit(1_000_000)) < F.lit(math.ceil(1_000_000 * 1.2 * most / n)))
        known = few if few.count() >= most else known  # too few by chance only
    return stored(known.orderBy(order, "doc_id").limit(most), "quality-sample")


def trained(rows: DataFrame, sample: DataFrame) -> AdditiveModel:
    """The model from ``rows`` of ``featured`` and a sample by ``chosen``; of rows that repeat an id one is taken, so that the driver gets no more rows than the sample has."""
    import numpy as np

    known = rows.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("features").alias("features"), F.first("label").alias("label"))
    found = known.select(F.xxhash64("doc_id").alias("order"), "features", "label").toPandas().sort_values("order", kind="stable")
    return fit(np.array(found["features"].tolist()).reshape(-1, len(FEATURES)), found["label"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """(doc_id, score) of every document."""
    rows = stored(featured(docs), "quality-features")
    model = trained(rows, chosen(labels, label_col))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.asarray(model.score(x)))], ["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that reach the threshold, all columns kept; only texts go through Python."""
    sample = chosen(labels)
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample.select("doc_id")), "doc_id")
    model = trained(featured(known), sample)  # features of the sample only

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in texts:
            yield pd.Series(model.score(feature_rows(x)), dtype=float)

    return docs.where(score(text_of(text_col)) >= threshold)


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = scored(docs, labels)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
