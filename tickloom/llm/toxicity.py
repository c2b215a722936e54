"""Toxicity from class-conditional Kneser-Ney models of how words are spelt.

Words of labelled texts are counted per class in one grouped aggregation. Each word is
read character by character in its context of up to five characters before it; a
class's probability of a character is its discounted count plus the discounted mass
times a Kneser-Ney backoff distribution that both classes share. In a context that
neither class has seen the two probabilities are the same, so rare expressions say
nothing. A text is scored by length-normalised differences of the two log-likelihoods,
over the whole text and over its most suspicious run of words and single words, and a
logistic curve, fitted on labelled texts whose words were not counted, turns these
into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import batched

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from tickloom.llm.common import quoted
from tickloom.session import staged

ORDER = 6  # characters of a gram: five of context and the one that follows
DISCOUNT = 0.75
MAX_LABELLED = 200_000  # labelled texts that are learned from, at most
WINDOW = 5  # words of a suspicious run
CALIBRATE_ONE_IN = 4  # labelled texts kept for the logistic curve
FEATURES = 4

_EDGES = re.compile(r"^\W+|\W+$")


def plain(token: str) -> str:
    """A lower-case token without the punctuation around it."""
    return _EDGES.sub("", token)


@dataclass
class Model:
    """Log-probability ratios by hash of a gram, by hash of a context for grams not seen there, and the curve."""

    grams: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.float32))
    contexts: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))
    base: float = 0.0


def _hashes(grams: list[str]) -> np.ndarray:
    """What Spark's xxhash64 gives for each string."""
    return np.array([xxhash.xxh64_intdigest(g.encode(), 42) for g in grams], np.uint64).view(np.int64)


def _found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is in a sorted table, and its value or 0."""
    at = np.minimum(np.searchsorted(table[0], keys), max(len(table[0]) - 1, 0))
    if not len(table[0]):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    known = table[0][at] == keys
    return known, np.where(known, table[1][at], 0.0)


class Ratios(dict):
    """log P(token | toxic) - log P(token | ordinary) by token; computed once, forgotten when too many are held."""

    def __init__(self, model: Model, most: int = 300_000):
        super().__init__()
        self.model, self.most = model, most

    def learn(self, tokens: set[str]) -> None:
        if len(self) + len(tokens) > self.most:
            self.clear()
        new = [t for t in tokens if t not in self]
        grams: list[str] = []
        ends = []
        for token in new:
            if word := plain(token):
                chars = "\u0002" * (ORDER - 1) + word + "\u0003"
                grams.extend([chars[i : i + ORDER] for i in range(len(word) + 1)])
            ends.append(len(grams))
        known, value = _found(self.model.grams, _hashes(grams))
        rest = np.flatnonzero(~known)
        value[rest] = _found(self.model.contexts, _hashes([grams[i][:-1] for i in rest]))[1]
        total = np.concatenate([[0.0], np.cumsum(value)])
        ends = np.array([0, *ends])
        self.update(zip(new, (total[ends[1:]] - total[ends[:-1]]).tolist(), strict=True))


def features(texts: list[str | None], ratios: Ratios) -> np.ndarray:
    """Ratios per character over each whole text and its worst run, its worst word and worst three words."""
    out = np.zeros((len(texts), FEATURES))
    split = [(t or "").lower().split() for t in texts]
    ratios.learn(set().union(*split))
    for row, words in zip(out, split, strict=True):
        if not words:
            continue
        value = np.fromiter(map(ratios.__getitem__, words), np.float64, len(words))
        size = np.fromiter(map(len, words), np.float64, len(words)) + 1
        total, chars = np.cumsum(value), np.cumsum(size)
        whole = run = total[-1] / chars[-1]
        if len(words) > WINDOW:
            run = np.max((total[WINDOW:] - total[:-WINDOW]) / (chars[WINDOW:] - chars[:-WINDOW]))
        top = value if len(words) <= 3 else np.partition(value, len(words) - 3)[-3:]
        row[:] = whole * 10, run, top.max() / 10, top.sum() / 30
    return out


def _labelled(labels: DataFrame, key: str, label: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and classes of at most ``most`` labelled texts, in an order free of their content."""
    known = labels.select(quoted(key).cast("long").alias("id"), quoted(label).cast("int").alias("toxic"))
    known = known.where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    rows = known.orderBy(F.xxhash64("id"), "id").limit(most).toPandas().sort_values("id")
    return rows["id"].to_numpy(np.int64), rows["toxic"].to_numpy(np.int8)


def _for_curve(ids: np.ndarray) -> np.ndarray:
    """Which labelled texts fit the curve and are not counted."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)) % np.uint64(CALIBRATE_ONE_IN) == 0


def _texts(batches: Iterator[pa.RecordBatch], ids: np.ndarray, toxic: np.ndarray) -> Iterator[tuple[str, int]]:
    for batch in batches:
        own = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
        found = (ids[at] == own) & ~batch.column(0).is_null().to_numpy(zero_copy_only=False)
        for row in np.flatnonzero(found):
            yield batch.column(1)[int(row)].as_py() or "", int(toxic[at[row]])


def _word_counts(ids: np.ndarray, toxic: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            both: dict[str, list[int]] = {}
            for label, seen in enumerate(counts):
                for token, n in seen.items():
                    if word := plain(token):
                        both.setdefault(word, [0, 0])[label] += n
                seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(both), pa.string()), *(pa.array([v[i] for v in both.values()], pa.int64()) for i in (1, 0))],
                names=["word", "t", "o"],
            )

        for text, label in _texts(batches, ids, toxic):
            counts[label].update(text.lower().split())
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield flush()
        yield flush()

    return run


def gram_table(words: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, context, t, o) of all words, each as often as its class has it."""
    spelt = F.concat(F.lit("\u0002" * (order - 1)), "word", F.lit("\u0003"))
    at = words.select(spelt.alias("s"), "t", "o").select(
        "s", "t", "o", F.explode(F.sequence(F.lit(1), F.length("s") - (order - 1))).alias("i")
    )
    grams = at.groupBy(F.substring("s", F.col("i"), F.lit(order)).alias("gram")).agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    return grams.withColumn("context", F.left("gram", F.lit(order - 1)))


def kneser_ney(grams: DataFrame, order: int = ORDER, discount: float = DISCOUNT) -> tuple[DataFrame, DataFrame]:
    """Ratios by gram and by context from ``gram_table``'s counts.

    The shared distribution of order k counts in how many different contexts a k-gram
    was seen, whatever the class, discounts each count and hands the mass to order k - 1.
    """
    kinds, types = {}, grams.select("gram")
    for k in range(order - 1, 0, -1):  # k-grams by how many (k+1)-grams end in them
        seen = types.groupBy(F.right("gram", F.lit(k)).alias("tail")).agg(F.count("*").alias("n"))
        kinds[k], types = seen, seen.select(F.col("tail").alias("gram"))
    letters = kinds[1].count()
    shared = grams.select("gram", F.lit(1.0 / max(letters, 1)).alias("p"))
    for k in range(1, order):
        around = kinds[k].groupBy(F.left("tail", F.lit(k - 1)).alias("head")).agg(F.sum("n").alias("all"), F.count("*").alias("followers"))
        part = kinds[k].withColumn("head", F.left("tail", F.lit(k - 1))).join(around, "head").drop("head")
        shared = shared.withColumn("tail", F.right("gram", F.lit(k))).join(part, "tail")
        mixed = (F.greatest(F.col("n") - discount, F.lit(0.0)) + discount * F.col("followers") * F.col("p")) / F.col("all")
        shared = shared.select("gram", mixed.alias("p"))
    contexts = grams.groupBy("context").agg(
        *[F.sum(c).alias(f"n_{c}") for c in "to"], *[F.sum((F.col(c) > 0).cast("long")).alias(f"k_{c}") for c in "to"]
    )
    full = grams.join(shared, "gram").join(contexts, "context")

    def chance(c: str) -> Column:
        seen = F.greatest(F.col(c) - discount, F.lit(0.0)) + discount * F.col(f"k_{c}") * F.col("p")
        return F.when(F.col(f"n_{c}") > 0, seen / F.col(f"n_{c}")).otherwise(F.col("p"))

    def handed(c: str) -> Column:
        return F.when(F.col(f"n_{c}") > 0, discount * F.col(f"k_{c}") / F.col(f"n_{c}")).otherwise(1.0)

    by_gram = full.select("gram", (F.log(chance("t")) - F.log(chance("o"))).alias("ratio"))
    by_context = contexts.select("context", (F.log(handed("t")) - F.log(handed("o"))).alias("ratio"))
    return by_gram, by_context.where("ratio <> 0")


def _table(ratios: DataFrame, key: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and their ratios: 12 bytes a gram, bounded by the labelled texts."""
    rows = ratios.select(F.xxhash64(key).alias("h"), F.col("ratio").cast("float").alias("ratio")).toArrow()
    keys, values = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order]


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a weak ridge, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.diag([0.05] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MAX_LABELLED) -> Model:
    """Learn from the texts of ``docs`` that ``labels`` marks 0 or 1 (the larger mark where it has several).

    ``most`` bounds the labelled texts and with them the model; the word and gram counts
    over those texts are exact, whole and aggregated by the cluster. Rows without id or
    label, and labels without text, teach nothing. Without both classes the model
    gives every text the share of toxic labels.
    """
    ids, toxic = _labelled(labels, key, label, most)
    base = float((toxic.sum() + 0.5) / (len(toxic) + 1)) if len(toxic) else 0.0
    curve = _for_curve(ids)
    if len(set(toxic[~curve])) < 2 or len(set(toxic[curve])) < 2:
        return Model(base=base)
    rows = docs.select(quoted(key).cast("long"), quoted(text).cast("string"))
    counted = rows.mapInArrow(_word_counts(ids[~curve], toxic[~curve]), "word string, t long, o long")
    words = staged(counted.groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o")))
    grams, contexts = kneser_ney(staged(gram_table(words)))
    model = Model(_table(grams, "gram"), _table(contexts, "context"), base=base)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = Ratios(held.value)
        for part in batched(_texts(batches, ids[curve], toxic[curve]), 128):
            x = features([t for t, _ in part], ratios)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.tolist(), pa.list_(pa.float64())), pa.array([y for _, y in part], pa.int32())], names=["x", "y"]
            )

    seen = rows.mapInArrow(measured, "x array<double>, y int").toPandas()
    if seen["y"].nunique() == 2:
        model.weights = _curve(np.array(seen["x"].tolist()), seen["y"].to_numpy(float))
    else:
        model.weights[-1] = math.log(base / (1 - base))
    return model


def toxicity(text: Column, docs: DataFrame, model: Model) -> Column:
    """Probability that a text is toxic; NULL and empty texts have no words and get what the curve gives them."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ratios = Ratios(held.value)
        weights, base = held.value.weights, held.value.base
        for batch in batches:
            if not len(held.value.grams[0]):
                yield pa.array([base] * len(batch), pa.float64())
                continue
            x = [features(batch.slice(lo, 128).to_pylist(), ratios) for lo in range(0, len(batch), 128)]
            x = np.concatenate([np.zeros((0, FEATURES)), *x])
            yield pa.array(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))), pa.float64())

    return F.arrow_udf(score, "double", ArrowUDFType.SCALAR_ITER)(text)
