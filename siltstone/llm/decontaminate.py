"""Benchmark decontamination by a prefix-filtered set join with exact windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import bloom
from siltstone.llm.stored import stored
from siltstone.llm.text import ALPHANUMERIC, LOWER, Rolling, Words, fingerprint, flat, ranges, signed, slices

_HITS = "array<struct<shingle:bigint,at:int,ctx_at:int,n_before:int,ctx:string>>"


class _Text:
    """Lower-cased words of a slice, with shingle hashes by size."""

    def __init__(self, column: pa.Array):
        data, offsets = flat(column)
        self.data = LOWER[data]
        self.words = Words(self.data, offsets, ALPHANUMERIC)
        self.rolling = Rolling(self.words.hashes)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        starts = _starts(self.words.offsets, size)
        return starts, self.rolling.of(starts, starts + size)

    def joined(self, start: int, stop: int) -> str:
        parts = (self.data[a:b].tobytes() for a, b in zip(self.words.starts[start:stop], self.words.stops[start:stop], strict=True))
        return b" ".join(parts).decode("utf-8")


def _starts(offsets: np.ndarray, size: int) -> np.ndarray:
    return ranges(offsets[:-1], np.maximum(np.diff(offsets) - size + 1, 0))


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = 10, shingle: int = 3) -> DataFrame:
    """Windows of ``window`` words of each item, or the one window of a shorter item.

    Rows: item, win (its words joined by a space), win_id, n (words), shingles (hashes of
    its runs of min(shingle, n) words, in order).  Items without words have none.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text = _Text(part.column("text"))
                rows = []
                for row, (a, b) in enumerate(zip(text.words.offsets[:-1], text.words.offsets[1:], strict=True)):
                    for start in range(a, max(b - window, a) + 1) if b > a else ():
                        stop = min(start + window, b)
                        size = min(shingle, stop - start)
                        begins = np.arange(start, stop - size + 1)
                        hashes = signed(text.rolling.of(begins, begins + size)).tolist()
                        rows.append((row, text.joined(start, stop), stop - start, hashes))
                yield pa.RecordBatch.from_pydict(
                    {
                        "item": part.column("item").take(pa.array([r[0] for r in rows], pa.int64())),
                        "win": pa.array([r[1] for r in rows], pa.string()),
                        "n": pa.array([r[2] for r in rows], pa.int32()),
                        "shingles": pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                    }
                )

    plain = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    cut_up = plain.mapInArrow(cut, "item string, win string, n int, shingles array<bigint>")
    return cut_up.withColumn("win_id", fingerprint("win"))


def shingle_counts(docs: DataFrame, wanted: np.ndarray, sizes: list[int], text_col: str = "text") -> DataFrame:
    """How often each shingle that the filter ``wanted`` lets pass occurs in all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text = _Text(part.column("text"))
                hashes = np.concatenate([text.shingles(size)[1] for size in sizes] or [np.zeros(0, np.uint64)])
                found, times = np.unique(hashes[bloom.holds(sent.value, hashes)], return_counts=True)
                yield pa.RecordBatch.from_pydict({"shingle": signed(found), "times": times.astype(np.int64)})

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "shingle bigint, times bigint")
    return counted.groupBy("shingle").agg(F.sum("times").alias("times"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """The rarest shingle of each distinct window: a document with the window must have it.

    Containment has to be whole, so a prefix of one token is enough.  Rarity is the number
    of occurrences in the corpus; ties go to the smaller hash, then to the earlier place.
    Rows: shingle, at (its first word within the window), win_id, win, n.
    """
    distinct = windows.select("win_id", "win", "n", "shingles").dropDuplicates(["win_id"])
    placed = distinct.select("win_id", "win", "n", F.posexplode("shingles").alias("at", "shingle"))
    rated = placed.join(counts, "shingle", "left")
    best = F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "shingle", "at", "win", "n")).alias("best")
    return rated.groupBy("win_id").agg(best).select("best.shingle", "best.at", "win_id", "best.win", "best.n")


def document_hits(docs: DataFrame, columns: list[str], wanted: np.ndarray, sizes: list[int], window: int, text_col: str = "text") -> DataFrame:
    """Per document: ``columns`` as c0, c1, ..., fp, n_words and places that may belong to a window.

    A place has the hash of its shingle, its first word (``at``), and up to ``window`` - 1
    words on either side as ``ctx``, which begins at word ``ctx_at``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text = _Text(part.column("text"))
                bounds = text.words.offsets
                rows: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for size in sizes:
                    starts, hashes = text.shingles(size)
                    chosen = bloom.holds(sent.value, hashes)
                    owners = np.searchsorted(bounds, starts[chosen], side="right") - 1
                    for start, value, row in zip(starts[chosen].tolist(), signed(hashes[chosen]).tolist(), owners.tolist(), strict=True):
                        first = max(start - window + 1, int(bounds[row]))
                        last = min(start + size + window - 1, int(bounds[row + 1]))
                        own = int(bounds[row])
                        rows[row].append({"shingle": value, "at": start - own, "ctx_at": first - own, "n_before": start - first, "ctx": text.joined(first, last)})
                kind = pa.list_(pa.struct([("shingle", pa.int64()), ("at", pa.int32()), ("ctx_at", pa.int32()), ("n_before", pa.int32()), ("ctx", pa.string())]))
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.diff(bounds), pa.int64()), pa.array(rows, kind)],
                    names=[*part.schema.names[:-1], "n_words", "hits"],
                )

    held = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    kept = docs.select(*held, fingerprint(text_col).alias("fp"), F.col(text_col).alias("text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(mark, f"{fields}, n_words bigint, hits {_HITS}")


def found_windows(hits: DataFrame, prefix: DataFrame) -> DataFrame:
    """Windows that occur: text fp, start, n, win_id, after comparing all their words.

    Positional bound: the shingle's place fixes where the window would begin; length
    bound: the window has to end within the words there are.
    """
    words = F.split("ctx", " ")
    begin = F.col("h.n_before") - F.col("p.at")
    pairs = hits.alias("h").join(prefix.alias("p"), F.col("h.shingle") == F.col("p.shingle"))
    fits = (begin >= 0) & (begin + F.col("p.n") <= F.size(words))
    same = F.array_join(F.slice(words, F.greatest(begin, F.lit(0)) + 1, F.col("p.n")), " ") == F.col("p.win")
    return pairs.where(fits & same).select("h.fp", (F.col("h.ctx_at") + begin).alias("start"), F.col("p.n").alias("n"), "p.win_id").distinct()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    shingle: int = 3,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``columns`` of it, text_fp, n_words, n_hit, n_items, item_ids, contaminated.

    A document word is hit when it lies inside an occurrence of a window of an item.  Null
    and empty texts have no words; items without words match nothing; equal items count each;
    rows with equal texts get equal results, repeated rows stay.  A null item id is no item in
    ``item_ids`` but its windows hit.  ``columns`` may have any names but those added.
    """
    columns = list(docs.columns) if columns is None else columns
    if clash := {c.lower() for c in columns} & {"text_fp", "n_words", "n_hit", "n_items", "item_ids", "contaminated"}:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    windows = stored(item_windows(items, item_col, item_text_col, window, shingle), "windows")
    every = windows.select(F.explode("shingles").alias("shingle")).distinct()
    sizes = list(range(1, shingle + 1)) if windows.where(F.col("n") < shingle).limit(1).count() else [shingle]
    counts = shingle_counts(docs, bloom.build(every, "shingle"), sizes, text_col)
    prefix = stored(prefixes(windows, counts), "prefixes")
    marked = stored(document_hits(docs, columns, bloom.build(prefix, "shingle"), sizes, window, text_col), "hits")
    places = marked.where(F.size("hits") > 0).select("fp", F.explode("hits").alias("hit")).select("fp", "hit.*").distinct()
    found = stored(found_windows(places, prefix), "found")
    cover = found.select("fp", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("word")).distinct()
    n_hit = cover.groupBy("fp").agg(F.count(F.lit(1)).alias("n_hit"))
    owners = windows.where(F.col("item").isNotNull()).select("win_id", "item").distinct()
    named = found.select("fp", "win_id").distinct().join(owners, "win_id").select("fp", "item").distinct()
    named = named.groupBy("fp").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    verdict = stored(n_hit.join(named, "fp", "left"), "verdict")
    joined = marked.drop("hits").join(verdict, "fp", "left")
    none = F.array().cast("array<string>")
    return joined.select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)),
        F.col("fp").alias("text_fp"),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size(F.coalesce("item_ids", none)), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
