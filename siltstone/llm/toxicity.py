"""Toxicity: a linear classifier of character n-grams, scaled by naive Bayes log-count ratios.

A text is the vector of how often each n-gram occurs in it, times how much likelier the n-gram is
in toxic texts, at unit length.  A logistic model with weights for both labels alike is fitted on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import bloom
from siltstone.llm.stored import stored
from siltstone.llm.text import fingerprint, fresh_name, mix, slices

#: n-grams are hashed into so many places.
PLACES = 1 << 18
#: Characters of an n-gram.
SIZES = (4, 6)
#: Distinct (text, n-gram) entries, about, that the one task that fits the model may hold: 8 bytes each.
SAMPLE_ENTRIES = 12_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20


def gram_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, times) of the n-grams of each text, in order.

    Texts are lower-cased, white space counts as one space, and there is one in front and behind.
    """
    parts = [f" {' '.join((t.as_py() or '').lower().split())} " for t in texts]
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    owner = np.repeat(np.arange(len(parts)), lengths)
    values = mix(codes.astype(np.uint64) + np.uint64(1))
    rolled, keys = np.zeros(len(codes), np.uint64), []
    for size in range(1, max(SIZES) + 1):
        count = max(len(codes) - size + 1, 0)
        rolled = mix(rolled[:count] * _STEP + values[size - 1 : size - 1 + count])
        if size in SIZES:
            within = owner[:count] == owner[size - 1 : size - 1 + count]
            keys.append(owner[:count][within] * PLACES + (rolled[within] >> np.uint64(46)).astype(np.int64))
    found, times = np.unique(np.concatenate(keys), return_counts=True)
    return found // PLACES, found % PLACES, times


@dataclass(frozen=True)
class Model:
    """Log-count ratio and weight of each place, bias, and the calibration of margins."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, row: np.ndarray, place: np.ndarray, times: np.ndarray, rows: int) -> np.ndarray:
        values = self.ratios[place] * times
        lengths = np.sqrt(np.bincount(row, values**2, rows))
        return np.bincount(row, values * self.weights[place], rows) / np.maximum(lengths, 1e-9) + self.bias

    def scores(self, row: np.ndarray, place: np.ndarray, times: np.ndarray, rows: int) -> np.ndarray:
        return _logistic(self.slope * self.margins(row, place, times, rows) + self.shift)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def labelled_texts(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """Distinct labelled texts: label, pick (a hash of the text, from 0 to 1), fp, text.

    A text that stands on many rows, or has many ids, is one row for each of its labels 0 and 1.  Ids and
    fingerprints meet their labels first; then one id of each text is chosen, and only the rows of chosen
    ids are shuffled with their texts.  Null ids have no label, null texts are empty.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    plain = docs.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), fingerprint(text_col).alias("fp"), text.alias("text"))
    pairs = plain.groupBy("id", "fp").agg(F.count(F.lit(1)).alias("n")).drop("n")
    chosen = pairs.join(known.hint("merge"), "id").groupBy("fp", "label").agg(F.min("id").alias("id"))
    chosen = stored(chosen.groupBy("id", "fp").agg(F.array_sort(F.collect_set("label")).alias("labels")), "chosen-texts")
    wanted = bloom.build(chosen.select(F.xxhash64("id", "fp").alias("key")), "key")
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = bloom.holds(sent.value, batch.column("key").to_numpy().view(np.uint64))
            yield batch.select(["id", "fp", "text"]).filter(pa.array(kept))

    kind = plain.schema["id"].dataType.simpleString()
    rows = plain.select("id", "fp", "text", F.xxhash64("id", "fp").alias("key")).mapInArrow(choose, f"id {kind}, fp binary, text string")
    once = rows.groupBy("id", "fp").agg(F.first("text").alias("text"))
    found = once.join(chosen.hint("merge"), ["id", "fp"])
    pick = F.conv(F.hex(F.substring("fp", 1, 4)), 16, 10).cast("double") / 2**32
    return found.select(F.explode("labels").alias("label"), pick.alias("pick"), "fp", "text")


def counted_places(texts: DataFrame) -> DataFrame:
    """In how many texts of each label an n-gram occurs: place, ones, every."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, PLACES), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                row, place, _ = gram_counts(part.column("text"))
                label = part.column("label").to_numpy()
                np.add.at(totals, (label[row], place), 1)
        found = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_pydict({"place": found.astype(np.int32), "ones": totals[1][found].astype(np.int32), "zeros": totals[0][found].astype(np.int32)})

    rows = texts.select("label", "text").mapInArrow(count, "place int, ones int, zeros int")
    return rows.groupBy("place").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))


def log_count_ratios(counted: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """How much likelier each place is in toxic texts, as a logarithm; 0 for those never seen.  ``PLACES`` numbers at most."""
    found = counted.toArrow()
    place = found.column("place").to_numpy()
    ones, zeros = np.full(PLACES, smoothing), np.full(PLACES, smoothing)
    ones[place] += found.column("ones").to_numpy()
    zeros[place] += found.column("zeros").to_numpy()
    ratios = np.log(ones / ones.sum()) - np.log(zeros / zeros.sum())
    unseen = np.ones(PLACES, bool)
    unseen[place] = False
    ratios[unseen] = 0.0
    return ratios


class _Rows:
    """Entries of labelled texts in flat arrays, as values of unit length."""

    def __init__(self, bounds: np.ndarray, places: np.ndarray, values: np.ndarray, labels: np.ndarray):
        self.bounds, self.places, self.values, self.labels = bounds, places, values, labels

    def _blocks(self) -> Iterator[tuple[int, int]]:
        low = 0
        while low < len(self.labels):
            high = max(int(np.searchsorted(self.bounds, self.bounds[low] + _BLOCK, side="right")) - 1, low + 1)
            yield low, high
            low = high

    def margins(self, weights: np.ndarray, bias: float) -> np.ndarray:
        parts = [np.zeros(0)]
        for low, high in self._blocks():
            a, b = self.bounds[low], self.bounds[high]
            owner = np.repeat(np.arange(high - low), np.diff(self.bounds[low : high + 1]))
            parts.append(np.bincount(owner, self.values[a:b] * weights[self.places[a:b]], high - low) + bias)
        return np.concatenate(parts)

    def gradient(self, pulls: np.ndarray, places: int) -> np.ndarray:
        total = np.zeros(places)
        for low, high in self._blocks():
            a, b = self.bounds[low], self.bounds[high]
            total += np.bincount(self.places[a:b], self.values[a:b] * np.repeat(pulls[low:high], np.diff(self.bounds[low : high + 1])), places)
        return total

    def some(self, chosen: np.ndarray) -> _Rows:
        counts = np.diff(self.bounds)[chosen]
        keep = np.repeat(chosen_mask(chosen, len(self.labels)), np.diff(self.bounds))
        return _Rows(np.concatenate([[0], np.cumsum(counts)]), self.places[keep], self.values[keep], self.labels[chosen])


def chosen_mask(chosen: np.ndarray, size: int) -> np.ndarray:
    mask = np.zeros(size, bool)
    mask[chosen] = True
    return mask


def fit_logistic(rows: _Rows, places: int, penalty: float = 0.1, rounds: int = 80) -> tuple[np.ndarray, float]:
    """Weights and bias of least logistic loss, labels weighing the same, by accelerated gradient steps.

    ``penalty`` is of the squared weights, over the number of rows.
    """
    signs = np.where(rows.labels == 1, 1.0, -1.0)
    share = np.where(rows.labels == 1, (rows.labels == 1).mean(), (rows.labels == 0).mean())
    gains = 0.5 / share / len(signs)
    shrink = penalty / len(signs)
    step = 1 / (0.5 + shrink)  # rows and bias have length 1 each
    weights, bias = np.zeros(places), 0.0
    ahead, ahead_bias, momentum = weights.copy(), 0.0, 1.0
    for _ in range(rounds):
        pulls = -signs * gains * _logistic(-signs * rows.margins(ahead, ahead_bias))
        new = ahead - step * (rows.gradient(pulls, places) + shrink * ahead)
        new_bias = ahead_bias - step * float(pulls.sum())
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pace, momentum = (momentum - 1) / following, following
        ahead, ahead_bias = new + pace * (new - weights), new_bias + pace * (new_bias - bias)
        weights, bias = new, new_bias
    return weights, bias


def calibrated(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make margins to probabilities, by a few Newton steps with a little shrinkage."""
    scale = max(float(np.abs(margins).mean()), 1e-9)
    x = np.stack([margins / scale, np.ones(len(margins))], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = _logistic(x @ at)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        move = np.clip(np.linalg.solve(hessian, x.T @ (p - labels) + 1e-2 * at), -2, 2)
        at = at - move
        if np.abs(move).max() < 1e-8:
            break
    return float(max(at[0], 1e-6) / scale), float(at[1])


def learn(docs: DataFrame, labels: DataFrame, sample_entries: int = SAMPLE_ENTRIES, **columns: str) -> Model:
    """A model from all documents of ``docs`` that ``labels`` knows.

    Log-count ratios come from all of their texts, copies counting once.  The linear model is fitted by one
    task on the texts of each label with the lowest hashes, so many that they have about half of ``sample_entries``
    entries each, and calibrated on another part of them.  Without texts of both labels every score is 1 if
    there are only ones, else 0.
    """
    texts = stored(labelled_texts(docs, labels, **columns), "labelled-texts")
    size = F.least(F.length("text") + 2, F.lit(PLACES // len(SIZES))) * len(SIZES)
    counts = {r.label: r for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("entries")).collect()}
    if set(counts) != {0, 1}:
        return Model(np.zeros(PLACES), np.zeros(PLACES), 0.0, 1.0, 700.0 if 1 in counts else -700.0)
    ratios = docs.sparkSession.sparkContext.broadcast(log_count_ratios(counted_places(texts)))
    sample = None
    for label, found in counts.items():
        rows = max(int(found.n * min(1.0, sample_entries / 2 / found.entries)), 1)
        lowest = texts.where(F.col("label") == label)
        if rows < found.n:  # hashes spread evenly: few more than wanted reach the task that sorts
            lowest = lowest.where(F.col("pick") <= (rows + 10 * rows**0.5 + 40) / found.n).orderBy("pick", "fp").limit(rows)
        sample = lowest if sample is None else sample.unionByName(lowest)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, names, counted, places, values = [], [], [], [], []
        for batch in batches:
            for part in slices(batch, "text"):
                row, place, times = gram_counts(part.column("text"))
                scaled = ratios.value[place] * times
                lengths = np.maximum(np.sqrt(np.bincount(row, scaled**2, part.num_rows)), 1e-9)
                counted.append(np.bincount(row, minlength=part.num_rows))
                places.append(place.astype(np.int32))
                values.append((scaled / lengths[row]).astype(np.float32))
                marks.append(part.column("label").to_numpy())
                names += part.column("fp").to_pylist()
        held = np.array([int.from_bytes(x[4:8], "big") for x in names]) % 4 == 3  # by the text, not by where it stands
        rows = _Rows(np.concatenate([[0], np.cumsum(np.concatenate(counted))]), np.concatenate(places), np.concatenate(values), np.concatenate(marks))
        del places, values
        both = lambda chosen: len(set(rows.labels[chosen].tolist())) == 2
        if both(~held) and both(held):
            weights, bias = fit_logistic(rows.some(np.flatnonzero(~held)), PLACES)
            slope, shift = calibrated(rows.margins(weights, bias)[held], rows.labels[held])
        else:
            weights, bias = fit_logistic(rows, PLACES)
            slope, shift = calibrated(rows.margins(weights, bias), rows.labels)
        yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()], "rest": [[bias, slope, shift]]})

    row = sample.coalesce(1).mapInArrow(fit, "weights binary, rest array<double>").first()
    return Model(ratios.value, np.frombuffer(row.weights), *row.rest)


def score(docs: DataFrame, model: Model, text_col: str = "text", cutoff: float = 0.3) -> DataFrame:
    """Adds score (0 to 1, higher: more likely toxic) and predicted (1 from ``cutoff`` on).

    Whole texts count, however long.  Null and empty texts have a score as well.  Rows keep all their columns, also
    repeated ones; columns called like an added one are an error.
    """
    if clash := {c.lower() for c in docs.columns} & {"score", "predicted"}:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    work = fresh_name(docs, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, work):
                scores = sent.value.scores(*gram_counts(part.column(work)), part.num_rows)
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                new = [pa.array(scores, pa.float64()), pa.array((scores >= cutoff).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=[*part.schema.names[:-1], "score", "predicted"])

    return docs.withColumn(work, F.col(f"`{text_col}`")).mapInArrow(rate, f"{fields}, score double, predicted int")
