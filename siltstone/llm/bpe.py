"""Byte-level BPE by prefix dynamic programming.

Every byte prefix of a piece has exactly one valid last token: the token with which the
encoding of that prefix ends.  Storing it for each prefix gives the encoding of every
prefix by walking back, lets text be appended without redoing what is there, and confines
an edit to the prefixes near it.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.text import fresh_name, give_back

#: Bytes of runs of text with their ids that an encoder remembers, and as many of older ones, and of pairs of tokens.
REMEMBERED_BYTES = 32 << 20
#: What a remembered run costs beside its own length, and what a pair of tokens costs.
_RUN_BYTES, _PAIR_BYTES = 180, 100
_NEVER = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Token ranks, which tokens end where in a text, and which two may stand next to each other."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        #: For each token on the left whether tokens may stand behind it, and how many are known.
        self.pairs: dict[int, dict[int, bool]] = {rank: {} for rank in ranks.values()}
        self.known = 0
        self._heads: dict[int, list[tuple[bytes, int]]] = {}
        self._tails: dict[int, list[tuple[bytes, int]]] = {}
        self._endings = ahocorasick.Automaton()
        for token, rank in ranks.items():
            parts, self._heads[rank], self._tails[rank] = self._merge(token)
            if parts == [token]:  # others are never the result of merging
                self._endings.add_word(token.decode("latin-1"), (rank, len(token)))
        self._endings.make_automaton()

    def endings(self, piece: bytes, begin: int = 0) -> Iterator[tuple[int, tuple[int, int]]]:
        """(place of the last byte, (rank, length)) of all tokens in ``piece`` from ``begin`` on, longest first."""
        return self._endings.iter(piece.decode("latin-1"), begin)

    def merged(self, piece: bytes) -> list[bytes]:
        """The defining procedure: merge the lowest-ranked neighbours, leftmost first, until none are left."""
        return self._merge(piece)[0] if piece else []

    def _merge(self, piece: bytes) -> tuple[list[bytes], list[tuple[bytes, int]], list[tuple[bytes, int]]]:
        """The parts left, and what the first and the last part were, each with the rank that ended it."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        heads, tails = [], []
        while len(parts) > 1:
            ranked = [(self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(ranked)
            if rank == _NEVER:
                break
            if i == 0:
                heads.append((parts[0], rank))
            if i == len(parts) - 2:
                tails.append((parts[-1], rank))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts, [*heads, (parts[0], _NEVER)], [*tails, (parts[-1], _NEVER)]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are when their bytes are merged together.

        They don't if, at some time, the last part of the one and the first part of the
        other make a token that ranks before what ends either part.  Of equal ranks the
        leftmost is merged first.  A token ranks behind its parts, so ranks tell the time.
        """
        if self.known * _PAIR_BYTES > REMEMBERED_BYTES:
            for row in self.pairs.values():
                row.clear()
            self.known = 0
        apart, rank_of = True, self.ranks.get
        for tail, tail_ends in self._tails[left]:
            for head, head_ends in self._heads[right]:
                rank = rank_of(tail + head)
                if rank is not None and rank < tail_ends and rank <= head_ends:
                    apart = False
        self.pairs[left][right] = apart
        self.known += 1
        return apart


def fill(vocabulary: Vocabulary, piece: bytes, last: list[int], done: int = 0, old: tuple[list[int], int, int] | None = None) -> int:
    """Adds to ``last``, which has -1 and the last tokens of the first ``done`` prefixes, those of longer ones; says how many there are then.

    Goes on to the end, or until as many in a row as the longest token has bytes are ``old`` ones, moved:
    the old list, where the edit ends, and by how much it moves what is behind.
    """
    add, neighbours, known, same = last.append, vocabulary.neighbours, vocabulary.pairs, 0
    for at, (rank, length) in vocabulary.endings(piece, max(0, done - vocabulary.longest)):
        if at < done:
            continue
        start = at + 1 - length
        if start:
            fits = known[last[start]].get(rank)
            if fits is None:
                fits = neighbours(last[start], rank)
            if not fits:
                continue
        add(rank)
        done += 1
        if old is not None:
            before, edited, shift = old
            same = same + 1 if done > edited and rank == before[done - shift] else 0
            if same == vocabulary.longest:
                return done
    if done != len(piece):
        raise ValueError(f"no token ends with byte {piece[done]:#04x}")
    return done


def walked_back(vocabulary: Vocabulary, last: list[int], at: int) -> list[int]:
    """The encoding of the first ``at`` bytes."""
    found, sizes = [], vocabulary.sizes
    while at:
        rank = last[at]
        found.append(rank)
        at -= sizes[rank]
    return found[::-1]


class PrefixEncoding:
    """The last token of each byte prefix of one piece: ``last[i]`` belongs to the first i bytes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last: list[int] = [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Adds bytes at the end; what is stored for shorter prefixes stays as it is."""
        done = len(self.piece)
        self.piece += more
        fill(self.vocabulary, self.piece, self.last, done)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Replaces bytes, and says how many prefixes were encoded anew.

        What is stored up to ``start`` stays.  Behind the edit, once as many last tokens in a row as the longest
        token has bytes are the old ones, moved by the change of length, all further ones are.
        """
        last = self.last
        edited, shift = start + len(new), len(new) - (stop - start)
        self.piece = self.piece[:start] + new + self.piece[stop:]
        self.last = last[: start + 1]
        done = fill(self.vocabulary, self.piece, self.last, start, (last, edited, shift))
        self.last += last[done + 1 - shift :]
        return done - start

    def ids(self, size: int | None = None) -> list[int]:
        """The encoding of the first ``size`` bytes."""
        return walked_back(self.vocabulary, self.last, len(self.piece) if size is None else size)


class Encoder(dict):
    """Texts to ids; as a mapping, remembered runs of text to their ids as little-endian bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self._older: dict[str, bytes] = {}
        self._held = 0
        self.vocabulary = Vocabulary(ranks)
        self.pieces = regex.compile(pattern).findall
        self._inside_spaces = regex.compile(r" \s").search
        size = max(ranks.values()) + 1
        self._lengths = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self._lengths[rank] = len(token)
        self._bytes = np.frombuffer(b"".join(self.vocabulary.tokens.get(i, b"") for i in range(size)), np.uint8)
        self._starts = np.cumsum(self._lengths) - self._lengths

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern; a match that is a token is that token."""
        whole = self.vocabulary.ranks.get(piece)
        if whole is not None:
            return [whole]
        last = [-1]
        return walked_back(self.vocabulary, last, fill(self.vocabulary, piece, last))

    def __missing__(self, run: str) -> bytes:
        packed = self._older.get(run)
        if packed is None:
            pieces = self.pieces(run)
            if len(pieces) == 1:
                packed = array("I", self.piece(run.encode())).tobytes()
            else:  # words are often known without what stands around them
                word = lambda p: p.isalpha() or (p[0] == " " and p[1:].isalpha())
                packed = b"".join([self[p] if word(p) else array("I", self.piece(p.encode())).tobytes() for p in pieces])
        if len(run) < 64:
            self._held += len(run) + len(packed) + _RUN_BYTES
            if self._held > REMEMBERED_BYTES:  # what is still in use comes back from the older ones
                self._older = dict(self)
                self.clear()
                self._held = 0
            self[run] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A space before something else than white space always begins a match, so such
        runs are encoded, and remembered, one by one.  This needs a pattern in which
        a space is the first character of a match or in a run of white space, and in which
        letters that are a match, with a space in front or without, are one by themselves.
        """
        if self._inside_spaces(text) or text.endswith(" "):
            return b"".join(map(self.__getitem__, self.pieces(text)))
        first, *rest = text.split(" ")
        return self[first] + b"".join([self[" " + run] for run in rest])

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self._lengths[ids]
        if (lengths == 0).any():
            raise ValueError("an id without a token")
        stops = np.cumsum(lengths)
        total = int(stops[-1]) if len(stops) else 0
        places = np.arange(total) + np.repeat(self._starts[ids] - (stops - lengths), lengths)
        return self._bytes[places].tobytes()


@functools.lru_cache(maxsize=2)
def shared_encoder(ranks_path: str, pattern: str) -> Encoder:
    """One encoder for all tasks that a Python worker runs."""
    return Encoder(load_ranks(ranks_path), pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids: bool = True) -> DataFrame:
    """Adds n_tokens, ids_sha256, decoded_sha256 and, unless ``ids`` is off, ids (array<int>).

    The digests are of the ids as little-endian unsigned 32-bit integers and of the bytes
    decoded from them.  ``ranks_path`` has to be readable on every executor.  A null text is encoded as an empty one: no ids.  Rows keep all their
    columns, whatever their names; columns called like an added one are an error.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if ids else [])]
    if clash := {c.lower() for c in docs.columns} & {*added}:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    work = fresh_name(docs, "text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    kinds = ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string", *(["ids array<int>"] if ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(ranks_path, pattern)
        for batch in batches:
            counts, digests, decoded, lists = [], [], [], []
            for text in batch.column(batch.num_columns - 1):
                packed = encoder.encode(text.as_py() or "")
                numbers = np.frombuffer(packed, "<u4")
                counts.append(len(numbers))
                digests.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(numbers)).hexdigest())
                if ids:
                    lists.append(pa.array(numbers.astype(np.int32)))
            new = [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            if ids:
                bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                flat = pa.concat_arrays(lists) if lists else pa.array([], pa.int32())
                new.append(pa.ListArray.from_arrays(pa.array(bounds), flat))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *new], names=[*batch.schema.names[:-1], *added])
        give_back()

    return docs.withColumn(work, F.col(f"`{text_col}`")).mapInArrow(run, ", ".join([*fields, *kinds]))
