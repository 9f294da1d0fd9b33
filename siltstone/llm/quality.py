"""Quality classifier: n-gram indicators scaled by log-count ratios under a linear hinge loss."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import bloom
from siltstone.llm.stored import stored
from siltstone.llm.text import NOT_SPACE, Rolling, Words, fingerprint, flat, fresh_name, mix, slices

#: Features are hashed into so many places.
PLACES = 1 << 18

# classes of bytes in the shape of a word: each ASCII sign is its own class
_SHAPE = np.arange(256, dtype=np.uint64)
_SHAPE[0x61:0x7B], _SHAPE[0x41:0x5B], _SHAPE[0x30:0x3A], _SHAPE[0x80:] = 0x61, 0x41, 0x30, 0x61
_SHAPE = mix(_SHAPE + np.uint64(0x5851F42D4C957F2D))


@dataclass(frozen=True)
class Model:
    """Weights by feature place (log-count ratio times support vector weight), bias and calibration.

    ``squares`` of the ratios give a text's length, by which its margin is divided.
    """

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, owner: np.ndarray, places: np.ndarray, rows: int) -> np.ndarray:
        lengths = np.sqrt(np.bincount(owner, self.squares[places], rows) + 1)
        margins = (np.bincount(owner, self.weights[places], rows) + self.bias) / lengths
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -700, 700)))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every distinct n-gram of each text, in order.

    N-grams are single words, and one to three word shapes in a row.  A shape is the
    sequence of character kinds in a word, with a mark if the word repeats the one before.
    """
    data, offsets = flat(column)
    words = Words(data, offsets, NOT_SPACE)
    owner = words.owners()
    kinds = _SHAPE[data]
    first = np.ones(len(data), bool)
    first[1:] = kinds[1:] != kinds[:-1]
    first[words.starts] = True
    kept = np.concatenate([[0], np.cumsum(first)])
    shapes = Rolling(kinds[first]).of(kept[words.starts], kept[words.stops])
    if len(owner):
        repeats = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
        shapes[1:][repeats] ^= np.uint64(0xA0761D6478BD642F)
    grams = [(owner, words.hashes)]
    rolling = Rolling(shapes)
    for size in (1, 2, 3):
        within = owner[: max(len(owner) - size + 1, 0)] == owner[size - 1 :]
        grams.append((owner[: len(within)][within], rolling.grams(size)[within]))
    keys = np.concatenate([o.astype(np.int64) * PLACES + (h >> np.uint64(46)).astype(np.int64) for o, h in grams])
    keys = np.unique(keys)
    return keys // PLACES, keys % PLACES


def labelled_features(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """One row per document and distinct label 0 or 1 of its id: label, fp (of its text), pick (from 0 to 1, by fp), places.

    Features are taken before labels are joined, from documents that may have one, so texts
    are not shuffled.  Null ids have no label, null texts are empty, repeated rows count each.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = stored(known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1)).distinct(), "labels")
    sent = docs.sparkSession.sparkContext.broadcast(bloom.build(known.select(F.xxhash64("id").alias("key")), "key"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    texts = texts.select("id", F.xxhash64("id").alias("key"), fingerprint("text").alias("fp"), "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = np.flatnonzero(bloom.holds(sent.value, batch.column("key").to_numpy().view(np.uint64)))
            for part in slices(batch.take(pa.array(chosen)), "text"):
                owner, places = features(part.column("text"))
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(places.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("fp"), lists], names=["id", "fp", "places"])

    kind = texts.schema["id"].dataType.simpleString()
    found = texts.mapInArrow(extract, f"id {kind}, fp binary, places array<int>")
    pick = F.conv(F.hex(F.substring("fp", 1, 4)), 16, 10).cast("double") / 2**32
    return found.join(known.hint("merge"), "id").select("label", "fp", pick.alias("pick"), "places")


def log_count_ratios(rows: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """log of how much likelier each place is under label 1 than under 0, from all rows.  Bounded by ``PLACES``."""
    counted = rows.select("label", F.explode("places").alias("place")).groupBy("place").agg(
        F.sum("label").alias("ones"), F.count(F.lit(1)).alias("every")
    )
    ones, zeros = np.full(PLACES, smoothing), np.full(PLACES, smoothing)
    found = counted.toArrow()
    place = found.column("place").to_numpy()
    ones[place] += found.column("ones").to_numpy()
    zeros[place] += found.column("every").to_numpy() - found.column("ones").to_numpy()
    ratios = np.log(ones / ones.sum()) - np.log(zeros / zeros.sum())
    unseen = np.ones(PLACES, bool)
    unseen[place] = False
    ratios[unseen] = 0.0
    return ratios


@dataclass(frozen=True)
class Sample:
    """Labelled texts as flat arrays: the places of text i are ``places[bounds[i] : bounds[i + 1]]``; ``times`` says on how many rows it stands."""

    places: np.ndarray
    bounds: np.ndarray
    labels: np.ndarray
    times: np.ndarray

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of ``values`` over the places of each text."""
        totals = np.concatenate([[0.0], np.cumsum(values[self.places])])
        return totals[self.bounds[1:]] - totals[self.bounds[:-1]]


def dual_coordinate_descent(sample: Sample, chosen: np.ndarray, ratios: np.ndarray, penalty: float, epochs: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear hinge-loss model on the scaled indicators of the ``chosen`` texts, label classes weighing the same."""
    labels, times = sample.labels[chosen], sample.times[chosen]
    signs = np.where(labels == 1, 1.0, -1.0)
    ones = times[labels == 1].sum() / times.sum()
    most = penalty * times / (2 * np.maximum(np.where(labels == 1, ones, 1 - ones), 1e-9))
    # rows of unit length, so that long texts weigh no more than short ones
    lengths = np.maximum(np.sqrt(sample.sums(ratios**2)[chosen] + 1), 1e-9)
    weights, bias, duals = np.zeros(len(ratios)), 0.0, np.zeros(len(chosen))
    order = np.random.default_rng(11)
    low, high = sample.bounds[:-1][chosen], sample.bounds[1:][chosen]
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(chosen)):
            places, scale = sample.places[low[i] : high[i]], 1 / lengths[i]
            values = ratios[places] * scale
            slope = signs[i] * (float(weights[places] @ values) + bias * scale) - 1
            new = min(max(duals[i] - slope, 0.0), most[i])
            step = (new - duals[i]) * signs[i]
            if step:
                weights[places] += step * values
                bias += step * scale
                duals[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights * ratios, bias


def _calibrate(margins: np.ndarray, labels: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins, by Newton's method with a little shrinkage."""
    scale = max(float(np.abs(margins).mean()), 1e-9)
    x = np.stack([margins / scale, np.ones(len(margins))], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -700, 700)))
        gradient = x.T @ (times * (p - labels)) + 1e-2 * at
        hessian = (x * (times * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(at[0], 1e-6) / scale), float(at[1])


def train(rows: DataFrame, sample_rows: int = 12_000, penalty: float = 1.0, epochs: int = 12) -> Model:
    """Fits a model to labelled features.

    Log-count ratios come from all rows.  The support vectors are fitted by one task on at most
    ``sample_rows`` distinct texts, half of them of either label, those of lowest ``pick``; a text weighs as many
    rows as it stands on.  The score is calibrated on the quarter of them with the highest ``pick``, or on all where
    that has one label only.  Without rows of both labels every score is the share of ones, or 1 without any.
    """
    texts = rows.groupBy("label", "fp").agg(F.count(F.lit(1)).alias("times"))
    counts = {r.label: r.n for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(counts.get(0, 0), counts.get(1, 0)) == 0:
        return Model(np.zeros(PLACES), np.zeros(PLACES), 0.0, 1.0, 700.0 if counts.get(1, 0) or not counts else -700.0)
    ratios = rows.sparkSession.sparkContext.broadcast(log_count_ratios(rows))
    half = max(sample_rows // 2, 1)
    sample = _lowest(rows, 0, half, counts[0]).unionByName(_lowest(rows, 1, half, counts[1]))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[np.ndarray]] = {name: [] for name in ("label", "pick", "times", "size", "places")}
        for batch in batches:
            lists = batch.column("places")
            parts["size"].append(np.diff(lists.offsets.to_numpy()))
            parts["places"].append(lists.flatten().to_numpy().copy())
            for name in ("label", "pick", "times"):
                parts[name].append(batch.column(name).to_numpy().copy())
        flat = {name: np.concatenate(found) for name, found in parts.items()}
        parts.clear()
        held = Sample(flat["places"], np.concatenate([[0], np.cumsum(flat["size"])]), flat["label"], flat["times"].astype(np.float64))
        order = np.lexsort((held.labels, flat["size"], flat["pick"]))  # not the order in which rows arrived
        cut = max(len(order) * 3 // 4, 1)
        both = lambda chosen: len(set(held.labels[chosen].tolist())) == 2
        fitted = order[:cut] if both(order[:cut]) else order
        weights, bias = dual_coordinate_descent(held, fitted, ratios.value, penalty, epochs)
        tested = order[cut:] if both(order[cut:]) else order
        margins = (held.sums(weights) + bias) / np.sqrt(held.sums(ratios.value**2) + 1)
        slope, shift = _calibrate(margins[tested], held.labels[tested], held.times[tested])
        yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()], "rest": [[bias, slope, shift]]})

    row = sample.coalesce(1).mapInArrow(fit, "weights binary, rest array<double>").first()
    return Model(np.frombuffer(row.weights), ratios.value**2, *row.rest)


def _lowest(rows: DataFrame, label: int, most: int, known: int) -> DataFrame:
    """``most`` of the ``known`` distinct texts with this label: those of lowest pick.

    Hashes spread evenly, so that few more than wanted are looked at; that they are fewer is all but impossible.
    """
    likely = rows.where((F.col("label") == label) & (F.col("pick") <= (most + 10 * most**0.5 + 40) / known))
    once = likely.groupBy("label", "fp", "pick").agg(F.count(F.lit(1)).alias("times"), F.first("places").alias("places"))
    return once.orderBy("pick", "fp").limit(most).select("label", "pick", "times", "places")


def score(docs: DataFrame, model: Model, text_col: str = "text", cutoff: float = 0.7) -> DataFrame:
    """Adds score (0 to 1) and predicted (1 from ``cutoff`` on).  Null and empty texts have no features but a score.

    Rows keep all their columns; columns called like an added one are an error.
    """
    if clash := {c.lower() for c in docs.columns} & {"score", "predicted"}:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    work = fresh_name(docs, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, work):
                scores = sent.value.scores(*features(part.column(work)), part.num_rows)
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                new = [pa.array(scores, pa.float64()), pa.array((scores >= cutoff).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=[*part.schema.names[:-1], "score", "predicted"])

    return docs.withColumn(work, F.col(f"`{text_col}`")).mapInArrow(rate, f"{fields}, score double, predicted int")


def learn(docs: DataFrame, labels: DataFrame, **columns: str) -> Model:
    """A model from all documents of ``docs`` that ``labels`` knows."""
    return train(stored(labelled_features(docs, labels, **columns), "quality"))
