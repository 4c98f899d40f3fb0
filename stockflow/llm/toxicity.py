"""Operator 1: toxicity by a chain of linear classifiers.

A text is a set of features: its words (runs of letters and digits, ASCII in
lower case) and their beginnings of 4, 5 and 6 bytes, hashed to a fixed number of
places. The categories are predicted one after the other by logistic models.
Each later model also gets the probabilities of the earlier ones. In training
these are out of fold: a row's probability comes from a model that has not seen
the row, so that later models learn how far earlier ones can be trusted on new
texts. The threshold of each category is chosen on out-of-fold probabilities,
for the mix of all labels: a row of the sample counts for as many as it stands for.

Training uses at most ``PER_CLASS`` labelled texts with and as many without the
last category, the first in hash order of their ids; the sample fits one task.
The model, a few numbers for each place, goes to the driver and to every task.
All documents are scored where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.textarrays import LOWER, NOT_LETTER, as_bytes, mix, span_hashes, word_bounds

PER_CLASS = 3_000
PLACES = 1 << 18
FOLDS = 3
STEPS = 100
LEAST, SIGNAL, RIDGE = 4, 12.0, 1e-4
BEGINNINGS = (4, 5, 6)


def features(text: str | None, places: int = PLACES) -> np.ndarray:
    """Sorted distinct places of a text's features."""
    raw = as_bytes(text)
    starts, ends = word_bounds(raw, NOT_LETTER)
    low = LOWER[raw]
    found = [span_hashes(low, starts, ends)]
    for n in BEGINNINGS:
        long = ends - starts > n
        # A beginning is another feature than an equal word.
        found.append(span_hashes(low, starts[long], starts[long] + n) + np.uint64(n))
    # Marks count one by one.
    marks = np.unique(raw[NOT_LETTER[raw]]).astype(np.uint64)
    found.append(mix(marks + np.uint64(1 << 40)))
    return np.unique((np.concatenate(found) >> np.uint64(20)) % np.uint64(places)).astype(np.int64)


class Rows:
    """Feature places of many texts, and dense columns beside them."""

    def __init__(self, places: list[np.ndarray], dense: np.ndarray) -> None:
        self.sizes = np.array([p.size for p in places])
        self.places = np.concatenate(places) if places else np.empty(0, np.int64)
        self.row = np.repeat(np.arange(len(places), dtype=np.int32), self.sizes)
        self.scale = 1 / np.sqrt(np.maximum(1, self.sizes))
        self.dense = dense

    def score(self, weights: np.ndarray, dense: np.ndarray, bias: float) -> np.ndarray:
        text = np.bincount(self.row, weights[self.places], len(self.sizes))
        return text * self.scale + self.dense @ dense + bias


def probability(score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def ratios(rows: Rows, y: np.ndarray, use: np.ndarray, places: int = PLACES) -> np.ndarray:
    """For each place the logarithm of how much more often it occurs with the category than without.

    0 for places that differ by less than chance would let some hundred of them
    differ (chi-squared under ``SIGNAL``) and for those in fewer than ``LEAST`` texts.
    """
    counts = [np.bincount(rows.places[(use & (y == label))[rows.row]], minlength=places) for label in (0, 1)]
    sizes = [max(1, int((use & (y == label)).sum())) for label in (0, 1)]
    both = counts[0] + counts[1]
    share = both / sum(sizes)
    spread = share * (1 - share) * (1 / sizes[0] + 1 / sizes[1])
    gap = counts[1] / sizes[1] - counts[0] / sizes[0]
    clear = (both >= LEAST) & (gap * gap > SIGNAL * np.maximum(spread, 1e-12))
    odds = np.log((counts[1] + 0.5) / (sizes[1] + 1)) - np.log((counts[0] + 0.5) / (sizes[0] + 1))
    return np.where(clear, odds, 0.0)


def fit(rows: Rows, y: np.ndarray, use: np.ndarray, places: int = PLACES, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on the rows in ``use``; both classes weigh the same.

    Features count with their log ratio, and weights on top of it start at 1 and
    are held near it, so that a few thousand texts suffice for many places.
    Adam, full batches.
    """
    weight = np.where(use, 1.0, 0.0)
    for label in (0, 1):
        mine = use & (y == label)
        weight[mine] /= max(1, mine.sum())
    ratio = ratios(rows, y, use, places)
    kept = np.flatnonzero(ratio)
    slot = np.full(places, -1)
    slot[kept] = np.arange(kept.size)
    on = slot[rows.places] >= 0
    at, row = slot[rows.places[on]], rows.row[on]
    value = ratio[kept][at] * rows.scale[row]
    n_dense = rows.dense.shape[1]
    theta, mean, square = np.zeros(kept.size + n_dense + 1), *np.zeros((2, kept.size + n_dense + 1))
    theta[: kept.size] = 1.0
    for step in range(1, steps + 1):
        text = np.bincount(row, value * theta[at], y.size)
        error = weight * (probability(text + rows.dense @ theta[kept.size : -1] + theta[-1]) - y)
        slope = np.bincount(at, value * error[row], kept.size) + RIDGE * (theta[: kept.size] - 1)
        slope = np.concatenate((slope, rows.dense.T @ error, [error.sum()]))
        mean += 0.1 * (slope - mean)
        square += 0.01 * (slope * slope - square)
        theta -= 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(places)
    weights[kept] = ratio[kept] * theta[: kept.size]
    return weights, theta[kept.size : -1], float(theta[-1])


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> float:
    """Middle of the widest gap between probabilities at which the F1 measure of the weighted rows is highest."""
    weight = np.ones(y.size) if weight is None else weight
    if not y.any():
        return 1.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum((y * weight)[order])
    f1 = 2 * hits / (np.cumsum(weight[order]) + (y * weight).sum())
    sorted_ = np.append(p[order], 0.0)
    last = sorted_[:-1] > sorted_[1:]
    best = np.flatnonzero(last & (f1 >= f1[last].max() - 1e-12)) if last.any() else np.array([y.size - 1])
    at = best[np.argmax(sorted_[best] - sorted_[best + 1])]
    return float((sorted_[at] + sorted_[at + 1]) / 2)


def fit_chain(
    places: list[np.ndarray], labels: np.ndarray, fold: np.ndarray, folds: int = FOLDS, weight: np.ndarray | None = None
) -> list[dict]:
    """A model for each column of ``labels``: weights, dense weights, bias, threshold.

    ``weight`` is the number of labelled rows that a row stands for when thresholds are chosen.
    """
    models, earlier = [], np.empty((len(places), 0))
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(float)
        rows = Rows(places, earlier)
        out = np.zeros(y.size)
        for f in range(folds):
            held = fold == f
            if held.any():
                out[held] = probability(rows.score(*fit(rows, y, ~held)))[held]
        weights, dense, bias = fit(rows, y, np.ones(y.size, bool))
        models.append({"weights": weights.astype(np.float32), "dense": dense, "bias": bias, "threshold": best_threshold(out, y, weight)})
        earlier = np.column_stack((earlier, out))
    return models


def predict(models: list[dict], place: np.ndarray) -> list[float]:
    """Probabilities of one text, category by category."""
    out: list[float] = []
    for m in models:
        score = m["weights"][place].sum(dtype=np.float64) / np.sqrt(max(1, place.size)) + m["bias"]
        out.append(float(probability(np.array(score + np.dot(m["dense"], out)))))
    return out


def lists_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as views of its numbers; as Python numbers they would take nine times as much."""
    lists = column.combine_chunks()
    return np.split(lists.flatten().to_numpy(), lists.value_lengths().to_numpy().cumsum()[:-1])


def sample_of(labels: DataFrame, categories: list[str], per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """doc_id and categories of at most ``per_class`` labelled documents with and without the last category; both counts over all."""
    known = labels.filter(F.col("doc_id").isNotNull() & ~F.greatest(*(F.col(c).isNull() for c in categories)))
    one = known.groupBy("doc_id").agg(*(F.max(F.col(c).cast("int")).alias(c) for c in categories))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    with_, without = (one.filter(F.col(categories[-1]) == v).orderBy(*order).limit(per_class) for v in (1, 0))
    counts = {int(label): n for label, n in one.groupBy(categories[-1]).count().collect()}
    return with_.union(without), counts


def train(docs: DataFrame, labels: DataFrame, categories: list[str], per_class: int = PER_CLASS) -> list[dict]:
    """The chain's models, in the order of ``categories``; none without a labelled document."""
    # At most 2 * per_class rows.
    sample, counts = sample_of(labels, categories, per_class)
    stands_for = {label: n / min(n, per_class) for label, n in counts.items()}
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", *categories).agg(F.min("text").alias("text"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).astype(np.int32) for t in batch.column(batch.num_columns - 1)]
            column = pa.array(found, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*batch.schema.names[:-1], "places"])

    columns = ", ".join(["doc_id long", *(f"{c} int" for c in categories), "places array<int>"])
    rows = texts.mapInArrow(featured, columns).withColumn("fold", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(FOLDS)))

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        places = lists_of(table.column("places"))
        truth = np.column_stack([table.column(c).to_numpy() for c in categories])
        weight = np.array([stands_for[int(label)] for label in truth[:, -1]])
        models = fit_chain(places, truth, table.column("fold").to_numpy(), weight=weight)
        return pa.Table.from_pylist(
            [m | {"nth": i, "weights": m["weights"].tobytes(), "dense": m["dense"].tolist()} for i, m in enumerate(models)],
            pa.schema(
                [("nth", pa.int32()), ("weights", pa.binary()), ("dense", pa.list_(pa.float64())), ("bias", pa.float64()), ("threshold", pa.float64())]
            ),
        )

    schema = "nth int, weights binary, dense array<double>, bias double, threshold double"
    found = rows.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(fitted, schema).collect()
    return [
        {"weights": np.frombuffer(m.weights, np.float32), "dense": np.array(m.dense), "bias": m.bias, "threshold": m.threshold}
        for m in sorted(found, key=lambda m: m.nth)
    ]


def score(docs: DataFrame, models: list[dict], categories: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, p_<category> for each category, the last category as a boolean of its name, and ``carry``.

    A null or empty text has no feature and gets the models' bias. Without
    models the probabilities are null and nothing is flagged. Rows are scored
    one by one, repeated rows and null ids included; columns named in ``carry``
    come along, others are ignored; an empty table gives no row.
    """
    names = [f"p_{c}" for c in categories]
    given = docs.select("doc_id", F.col("text").alias("scored"), *carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if models:
                out = [predict(models, features(t.as_py())) for t in batch.column(1)]
                flags = [p[-1] >= models[-1]["threshold"] for p in out]
            else:
                out, flags = [[None] * len(names)] * batch.num_rows, [False] * batch.num_rows
            columns = [pa.array([p[i] for p in out], pa.float64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(flags, pa.bool_()), *batch.columns[2:]],
                ["doc_id", *names, categories[-1], *carry],
            )

    columns = [f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[2:]]
    schema = ", ".join(["doc_id long", *(f"{n} double" for n in names), f"{categories[-1]} boolean", *columns])
    return given.mapInArrow(run, schema)


def toxic(
    docs: DataFrame, labelled: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Scores of ``docs`` (and their columns ``carry``) by a chain that is trained on ``labelled`` texts: low quality first, then toxicity."""
    categories = ["low_quality", "toxic"]
    table = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return score(docs, train(labelled, table, categories, per_class), categories, carry)
