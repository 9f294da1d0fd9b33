import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return bpe.shared_encoder(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t aAbßéñ1२'st!?-日本🙂\x00"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_same_ids_as_the_library(encoder, reference, text):
    ids = np.frombuffer(encoder.encode(text), "<u4")
    assert ids.tolist() == reference.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=30), st.binary(max_size=12), st.data())
def test_appends_and_edits(encoder, first, more, data):
    vocabulary = encoder.vocabulary

    def fresh(piece):
        return bpe.PrefixEncoding(vocabulary, piece).ids()

    held = bpe.PrefixEncoding(vocabulary, first)
    assert held.ids() == [vocabulary.ranks[t] for t in vocabulary.merged(first)]
    held.append(more)
    whole = first + more
    assert held.ids() == fresh(whole) and held.ids(len(first)) == fresh(first)
    start = data.draw(st.integers(0, len(whole)))
    stop = data.draw(st.integers(start, len(whole)))
    new = data.draw(st.binary(max_size=5))
    held.replace(start, stop, new)
    whole_again = bpe.PrefixEncoding(vocabulary, held.piece)
    assert held.last == whole_again.last
    assert held.piece == whole[:start] + new + whole[stop:] and held.ids() == fresh(held.piece)


def test_documents(docs_of, texts, untouched, reference):
    out = bpe.encode_documents(docs_of(texts), PATH, public_tokenizers.PATTERN)
    untouched(out)
    want = []
    for doc, text in texts:
        ids = reference.encode_ordinary(text or "")
        want.append((doc, text, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), ids))
    got = [tuple(r) for r in out.select("doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256", "ids").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert bpe.encode_documents(docs_of([]).limit(0), PATH, public_tokenizers.PATTERN).collect() == []


def test_memory_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 2000)
    small = bpe.Encoder(bpe.load_ranks(PATH), public_tokenizers.PATTERN)
    text = " ".join(f"word{i}" for i in range(200))
    assert small.encode(text) == encoder.encode(text)
    assert 0 < len(small) <= 11 and len(small._older) <= 11 and small.vocabulary.known <= 21
    assert small.encode(text) == encoder.encode(text)


def test_edits_stay_near(encoder):
    """A short edit in a long piece leaves what is stored far behind it alone, and the ids are right."""
    piece = "".join(f"abc{i}def" for i in range(3000)).encode()
    for start, stop, new in ((9000, 9003, b"q"), (0, 1, b""), (15000, 15000, b"inserted bytes"), (len(piece) - 2, len(piece), b"")):
        held = bpe.PrefixEncoding(encoder.vocabulary, piece)
        redone = held.replace(start, stop, new)
        fresh = bpe.PrefixEncoding(encoder.vocabulary, piece[:start] + new + piece[stop:])
        assert (held.piece, held.last, held.ids()) == (fresh.piece, fresh.last, fresh.ids())
        assert redone <= len(new) + 3 * encoder.vocabulary.longest


def test_unknown_id(encoder):
    with pytest.raises(IndexError):
        encoder.decode(np.array([10**6]))
