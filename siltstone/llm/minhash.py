"""Near-dedup by weighted minwise signatures from darts, bands of them, and exact similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import bloom
from siltstone.llm.components import components
from siltstone.llm.stored import stored
from siltstone.llm.text import NOT_SPACE, Rolling, Words, fingerprint, flat, fresh_name, mix, ranges, signed, slices

BANDS, ROWS = 32, 4
#: Darts thrown in one go.
DARTS = 1 << 20
_COUNTERS = 1 << 20

_LAYER, _DART = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def shingle_layers(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The weighted shingles of each text in unit layers: (row, element), and the weight of each row.

    A shingle that occurs c times has weight c: c elements, one per layer.  The weighted
    Jaccard similarity of two texts is then the plain one of their elements.  A text of fewer
    than ``size`` words is one shingle, a text without words has none.
    """
    words = Words(*flat(column), NOT_SPACE)
    counts = np.diff(words.offsets)
    per_row = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    starts = ranges(words.offsets[:-1], per_row)
    owner = np.repeat(np.arange(len(counts)), per_row)
    stops = np.minimum(starts + size, words.offsets[1:][owner])
    hashes = Rolling(words.hashes).of(starts, stops)
    # equal shingles of a row come to stand together
    order = np.argsort(mix(hashes + owner.astype(np.uint64) * _LAYER), kind="stable")
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(hashes)), 0))
    layer = (np.arange(len(hashes)) - first).astype(np.uint64)
    elements = mix(hashes + layer * _LAYER)
    back = np.argsort(owner, kind="stable")
    return owner[back], elements[back]


def throw_darts(owner: np.ndarray, elements: np.ndarray, rows: int, size: int) -> np.ndarray:
    """Signatures of ``size`` coordinates: for each the id of the earliest dart that hit the row's weight.

    Along the time axis, every unit of weight is hit by darts at a steady rate of one; where and
    when follows from hashes of the unit alone, so equal units of two texts are hit by the same
    darts.  A dart belongs to a coordinate by its hash.  Looking until time t, a row of weight w
    sees about t * w darts: t is chosen so that most rows see each coordinate hit, whatever their
    weight, and doubled for the others.  Two rows agree in a coordinate with the probability of
    their weighted Jaccard similarity.  Rows without weight have ids 0.
    """
    signature = np.zeros(rows * size, np.uint64)
    earliest = np.full(rows * size, np.inf)
    weight = np.bincount(owner, minlength=rows)
    until = np.where(weight > 0, size * (math.log(size) + 4) / np.maximum(weight, 1), 0.0)
    open_rows = weight > 0
    while open_rows.any():
        chosen = open_rows[owner]
        active, row = elements[chosen], owner[chosen]
        at, wanted, number = np.zeros(len(active)), 1, 0
        while len(active):
            block = max(min(wanted, DARTS // len(active)), 1)
            darts = mix(active[:, None] + (np.arange(number, number + block, dtype=np.uint64) + np.uint64(1)) * _DART)
            times = at[:, None] + np.cumsum(-np.log((darts >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54), axis=1)
            hits = times <= until[row][:, None]
            found, when = mix(darts[hits] ^ _LAYER), times[hits]
            cell = np.repeat(row, hits.sum(axis=1)) * size + (found % np.uint64(size)).astype(np.int64)
            np.minimum.at(earliest, cell, when)
            best = when == earliest[cell]
            signature[cell[best]] = found[best]
            going = hits[:, -1]
            active, row, at = active[going], row[going], times[going, -1]
            number, wanted = number + block, min(block * 8, 512)
        missing = np.isinf(earliest).reshape(rows, size).any(axis=1) & open_rows
        until = np.where(missing, until * 2, until)
        open_rows = missing
    return signature.reshape(rows, size)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signature), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _DART
    for i in range(rows):
        keys = mix(keys * _LAYER + signature[:, i : bands * rows : rows])
    return keys


def sketches(docs: DataFrame, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """fp, weight and bands of each row's text."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                owner, elements = shingle_layers(part.column("text"), size)
                keys = band_keys(throw_darts(owner, elements, part.num_rows, bands * rows), bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * bands), pa.array(signed(keys.ravel())))
                weight = np.bincount(owner, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("fp"), pa.array(weight), lists], names=["fp", "weight", "bands"])

    plain = docs.select(fingerprint(text_col).alias("fp"), F.col(text_col).alias("text"))
    return plain.mapInArrow(sketch, "fp binary, weight bigint, bands array<bigint>")


def shingle_sets(docs: DataFrame, wanted: np.ndarray, text_col: str, size: int) -> DataFrame:
    """fp and sorted elements (64-bit, packed) of the distinct texts that the filter ``wanted`` lets pass."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = np.flatnonzero(bloom.holds(sent.value, batch.column("key").to_numpy().view(np.uint64)))
            for part in slices(batch.take(pa.array(chosen)), "text"):
                owner, elements = shingle_layers(part.column("text"), size)
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
                packed = [np.sort(elements[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("fp"), pa.array(packed, pa.binary())], names=["fp", "elements"])

    plain = docs.select(fingerprint(text_col).alias("fp"), F.col(text_col).alias("text"))
    plain = plain.select("fp", F.xxhash64("fp").alias("key"), "text")
    return plain.mapInArrow(gather, "fp binary, elements binary").dropDuplicates(["fp"])


def similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those (a, b) of ``pairs`` whose weighted Jaccard similarity is at least ``threshold``."""
    with_a = pairs.join(sets.toDF("a", "elements_a"), "a")
    both = with_a.join(sets.toDF("b", "elements_b"), "b").select("a", "b", "elements_a", "elements_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("elements_a"), batch.column("elements_b"), strict=True):
                left, right = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                same = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(same >= threshold * (len(left) + len(right) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(compare, "a binary, b binary")


def near_duplicates(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = 5, threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS, wordless: bool = False
) -> DataFrame:
    """(fp, class_id) for each distinct text that has words, or with ``wordless`` for each: the smallest id of its class.

    Texts are linked when the weighted Jaccard similarity of their word shingles is at least
    ``threshold``; classes are connected components of links.  Candidates agree in a band; a
    pair of similarity s agrees in none with probability (1 - s**rows)**bands, 5e-8 at 0.8.
    Equal texts are one candidate.  In each band the members of a bucket are compared with the one
    of them that shares the most bands with others.  What is then still apart from others of its
    bucket goes through an exact prefix filter, so no link between classes is lost, a large class
    is never expanded into its pairs, nor are texts that have one passage in common.  Ids that are null name no class; if all are, class_id is null.
    Texts without words are linked to no other text.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    reps = stored(sketches(plain, "text", size, bands, rows).where(F.col("weight") > 0).dropDuplicates(["fp"]), "sketches")
    members = reps.select("fp", "weight", F.explode("bands").alias("band"))
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    buckets = stored(members.join(stored(sizes, "bucket-sizes").hint("merge"), "band"), "bucket-members")
    # the text that others are copies of agrees with more of them than they do with each other
    popular = stored(buckets.groupBy("fp").agg(F.sum("n").alias("popular")), "popular")
    rated = buckets.drop("n").join(popular.hint("merge"), "fp")
    best = F.max(F.struct("popular", "fp", "weight")).alias("best")
    centres = rated.groupBy("band").agg(best).select("band", F.col("best.fp").alias("centre"), F.col("best.weight").alias("centre_weight"))
    buckets = stored(buckets.drop("n").join(stored(centres, "centres").hint("merge"), "band"), "bucket-centres")
    close = F.least("weight", "centre_weight") >= threshold * F.greatest("weight", "centre_weight")
    pairs = buckets.where((F.col("fp") != F.col("centre")) & close)
    pairs = pairs.select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b"))
    keys = stored(buckets.select(F.xxhash64("fp").alias("key")).distinct(), "bucket-keys")
    sets = stored(shingle_sets(plain, bloom.build(keys, "key"), "text", size), "shingle-sets")
    links = stored(similar(stored(pairs.distinct(), "pairs"), sets, threshold), "near-links")
    labels = components(links)
    more = _across(buckets, labels, sets, threshold)
    if not more.isEmpty():
        links = links.unionByName(stored(similar(more, sets, threshold), "near-links"))
        labels = components(links)
    texts = plain.select("id", fingerprint("text").alias("fp")).groupBy("fp").agg(F.min("id").alias("id"))
    texts = stored(texts if wordless else texts.join(reps.select("fp"), "fp", "left_semi"), "texts")
    named = stored(texts.join(labels.toDF("fp", "label"), "fp", "left").select("fp", "id", F.coalesce("label", "fp").alias("label")), "texts")
    classes = stored(named.groupBy("label").agg(F.min("id").alias("class_id")), "classes")
    return stored(named.join(classes, "label").select("fp", "class_id"), "near-classes")


def _across(buckets: DataFrame, labels: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs that may be linked though in different classes, each once, by prefix filtering.

    Looks at texts that share a band with one of another class.  When the elements of all texts
    are put in the same order, rare ones first, linked texts of n elements have one in common
    among their first n - ceil(threshold * n) + 1.  What many texts share comes late in that order,
    where its place bounds how much they can have in common.
    """
    known = stored(labels.toDF("fp", "label"), "labels").hint("merge")
    named = buckets.join(known, "fp", "left").select("band", "fp", F.coalesce("label", "fp").alias("label"))
    named = stored(named, "bucket-labels")
    mixed = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(F.col("low") < F.col("high"))
    named = named.join(stored(mixed.select("band"), "mixed").hint("merge"), "band").select("fp", "label").distinct()
    named = stored(sets.join(stored(named, "mixed-members").hint("merge"), "fp"), "mixed-sets")
    prefixed = stored(_prefixes(named, _element_counts(named), threshold), "prefixes")
    left, right = (prefixed.toDF("element", x, f"label_{x}", f"weight_{x}", f"at_{x}") for x in "ab")
    # no more can be common than what stands from there on; at the first common element that is a bound
    most = F.least(F.col("weight_a") - F.col("at_a"), F.col("weight_b") - F.col("at_b"))
    enough = most >= threshold / (1 + threshold) * (F.col("weight_a") + F.col("weight_b")) - 1e-6
    apart = (F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b"))
    pairs = left.join(right.hint("merge"), "element").where(apart & enough)
    return stored(pairs.select("a", "b").distinct(), "more-pairs")


def _element_counts(sets: DataFrame) -> np.ndarray:
    """Occurrences of elements, added up in ``_COUNTERS`` places by hash: a bounded table that gives an order."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_COUNTERS, np.int64)
        for batch in batches:
            for packed in batch.column("elements"):
                np.add.at(total, _counter(np.frombuffer(packed.as_buffer(), np.uint64)), 1)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"place": found, "n": total[found]})

    added = sets.select("elements").mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_COUNTERS, np.int64)
    counts[added.column("place").to_numpy()] = added.column("n").to_numpy()
    return counts


def _counter(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(44)).astype(np.int64)


def _prefixes(sets: DataFrame, counts: np.ndarray, threshold: float) -> DataFrame:
    sent = sets.sparkSession.sparkContext.broadcast(counts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, weights, places = [], [], []
            for packed in batch.column("elements"):
                elements = np.frombuffer(packed.as_buffer(), np.uint64)
                order = np.lexsort((elements, sent.value[_counter(elements)]))
                # a little more than needed, for rounding
                chosen.append(elements[order[: len(elements) - math.ceil(threshold * len(elements) - 1e-9) + 1]])
                weights.append(len(elements))
                places.append(np.arange(len(chosen[-1])))
            rows = np.repeat(np.arange(len(chosen)), [len(x) for x in chosen])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate([*chosen, np.zeros(0, np.uint64)]))),
                    batch.column("fp").take(pa.array(rows)),
                    batch.column("label").take(pa.array(rows)),
                    pa.array(np.array(weights, np.int64)[rows]),
                    pa.array(np.concatenate([*places, np.zeros(0, np.int64)])),
                ],
                names=["element", "fp", "label", "weight", "at"],
            )

    return sets.select("fp", "label", "elements").mapInArrow(cut, "element bigint, fp binary, label binary, weight bigint, at bigint")


def classify(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """All rows of ``docs`` with class_id and kept.

    class_id is the smallest id of the class, for texts without words the own id: these are
    never linked, not even with each other, unless ``wordless`` makes equal ones a class.  kept
    marks the rows with that id.  Repeated rows with the same id and text share their marks.
    """
    if clash := {c.lower() for c in docs.columns} & {"class_id", "kept"}:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    found = near_duplicates(docs, text_col, id_col, **options)
    key, named = fresh_name(docs, "fp"), fresh_name(docs, "class")
    joined = docs.withColumn(key, fingerprint(text_col)).join(found.toDF(key, named).hint("merge"), key, "left")
    own = F.col(f"`{id_col}`")
    # without words there is no class
    class_id = F.coalesce(F.col(named), own)
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), class_id.alias("class_id"), own.eqNullSafe(class_id).alias("kept"))


def survivors(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, one of each class; of rows with equal id and text, one.

    Null texts are texts without words: each stays, or with ``wordless`` one of all null and empty ones.  Rows without
    id stay if their whole class has none.
    """
    kept = classify(docs, text_col, id_col, **options).where("kept").select(docs.columns)
    key = fresh_name(docs, "fp")
    keyed = kept.withColumn(key, F.struct(F.col(f"`{id_col}`").alias("id"), fingerprint(text_col).alias("fp")))
    # few or none: they are looked for in ids and fingerprints alone
    twice = stored(keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(key), "repeated-rows")
    if twice.isEmpty():
        return kept
    twice = twice.withColumnRenamed(key, "k")
    repeated = F.col(key).eqNullSafe(F.col("k"))
    once = keyed.join(twice, repeated, "left_anti")
    one = keyed.join(twice, repeated, "left_semi").dropDuplicates([key])
    return once.unionByName(one).select(docs.columns)
