"""Language identification by hyperdimensional profiles of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.text import fresh_name, mix, slices

#: Components of a hypervector.
SIZE = 1024
_LETTERS = 64
_NONE = "und"
_PARTS = 32
_classes: list[np.ndarray] = []


def _class_of() -> np.ndarray:
    """1 to 63 for letters of any script, by a hash of the code point; 0 for all else."""
    if not _classes:
        points = np.arange(0x110000, dtype=np.uint64)
        table = (mix(points * np.uint64(0x9FB21C651E98DF25)) % np.uint64(_LETTERS - 1) + np.uint64(1)).astype(np.uint8)
        table[0x61:0x7B] = np.arange(1, 27)
        table[~np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)] = 0
        _classes.append(table)
    return _classes[0]


def letter_vectors(size: int = SIZE) -> np.ndarray:
    """A fixed random vector of -1 and 1 for each letter class and for the gap between words."""
    seeds = np.arange(_LETTERS * size, dtype=np.uint64).reshape(_LETTERS, size) + np.uint64(1)
    return ((mix(seeds * np.uint64(0xA24BAED4963EE407)) >> np.uint64(40)) & np.uint64(1)).astype(np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Binds letters to an n-gram: the first rotated by two, times the second rotated by one, times the third."""
    first, second, third = grams >> 12, (grams >> 6) & 63, grams & 63
    return np.roll(letters, 2, axis=1)[first] * np.roll(letters, 1, axis=1)[second] * letters[third]


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, trigram) pairs of a slice, and which documents have a letter.

    Texts are lower-cased; runs of other characters count as one gap, at both ends too.
    """
    parts = [(t.as_py() or "").lower() for t in texts]
    joined = " ".join(parts) + " "
    codes = _class_of()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    owner = np.repeat(np.arange(len(parts)), lengths)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    keep[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = True
    codes, owner = codes[keep].astype(np.int64), owner[keep]
    has_letter = np.bincount(owner, codes > 0, len(parts)) > 0
    # a document begins with the gap that ends the one before it
    before = np.concatenate([[0], codes[:-1]])
    after = np.concatenate([codes[1:], [0]])
    inside = codes > 0
    return owner[inside], (before << 12 | codes << 6 | after)[inside], has_letter


def gram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """How often each trigram occurs in the texts of each language: lang, gram, times.

    Null languages teach nothing, null and empty texts have no trigrams, repeated rows count each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                owner, grams, _ = _grams(part.column("text"))
                langs = part.column("lang").to_pylist()
                names = sorted(set(langs))
                number = {name: i for i, name in enumerate(names)}
                of = np.array([number[x] for x in langs], np.int64)[owner]
                for i, name in enumerate(names):
                    times = np.bincount(grams[of == i], minlength=_LETTERS**3)
                    held[name] = held[name] + times if name in held else times
                if len(held) > 64:
                    yield from _as_rows(held)
                    held = {}
        yield from _as_rows(held)

    plain = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(F.col("lang").isNotNull())
    counted = plain.mapInArrow(count, "lang string, gram bigint, times bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("times").alias("times"))


def _as_rows(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for name, times in held.items():
        found = np.flatnonzero(times)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(found), pa.string()), "gram": found, "times": times[found]})


def prototypes(counts: DataFrame, size: int = SIZE) -> dict[str, np.ndarray]:
    """The bundle of all n-gram vectors of each language, as a unit vector; no counts give no profiles.

    What the driver gets is ``_PARTS`` vectors per language.
    """

    def bundle(key: tuple, group: pa.Table) -> pa.Table:
        grams = group.column("gram").to_numpy()
        times = group.column("times").to_numpy().astype(np.float64)
        total = times @ gram_vectors(grams, letter_vectors(size)).astype(np.float64)
        return pa.table({"lang": [key[0].as_py()], "vector": [total]})

    # whole numbers, so that parts add up to the same in any order
    parts = counts.groupBy("lang", F.pmod("gram", F.lit(_PARTS)).alias("part")).applyInArrow(bundle, "lang string, vector array<double>")
    totals: dict[str, np.ndarray] = {}
    for row in parts.toLocalIterator():
        totals[row.lang] = totals.get(row.lang, 0) + np.array(row.vector)
    return {lang: totals[lang] / max(np.linalg.norm(totals[lang]), 1e-300) for lang in sorted(totals)}


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """Adds lang_pred and score, the cosine of the document's bundle with its language's (0 if below).

    ``und`` with score 0 where the text is null or has no letter, and where no profile is
    given.  Ties go to the first name.  Whole texts count; rows keep all their columns, and
    columns called like an added one are an error.
    """
    if clash := {c.lower() for c in docs.columns} & {"lang_pred", "score"}:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    names = sorted(profiles)
    matrix = np.array([profiles[n] for n in names], np.float32)
    work = fresh_name(docs, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_vectors(matrix.shape[1]) if names else None
        for batch in batches:
            for part in slices(batch, work, 1 << 20):
                found, best = [_NONE] * part.num_rows, np.zeros(part.num_rows)
                if names:
                    owner, grams, has_letter = _grams(part.column(work))
                    present = np.bincount(grams, minlength=_LETTERS**3) > 0
                    place = np.cumsum(present) - 1
                    vectors = gram_vectors(np.flatnonzero(present), letters).astype(np.float32)
                    width = max(len(vectors), 1)
                    times = np.bincount(owner * width + place[grams], minlength=part.num_rows * width)
                    bundles = times.reshape(part.num_rows, width)[:, : len(vectors)].astype(np.float32) @ vectors
                    norms = np.maximum(np.linalg.norm(bundles, axis=1), 1e-30)
                    cosines = bundles @ matrix.T / norms[:, None]
                    which = cosines.argmax(axis=1)
                    best = np.where(has_letter, np.clip(cosines.max(axis=1), 0, 1), 0).astype(np.float64)
                    found = [names[w] if h else _NONE for w, h in zip(which, has_letter, strict=True)]
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(found, pa.string()), pa.array(best, pa.float64())],
                    names=[*part.schema.names[:-1], "lang_pred", "score"],
                )

    return docs.withColumn(work, F.col(f"`{text_col}`")).mapInArrow(compare, f"{fields}, lang_pred string, score double")
