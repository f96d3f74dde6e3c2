import base64
import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers as public
from lectern.llm import bpe

PATH = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(texts):
    done = bpe.Encoded(pa.array(texts, pa.string()), bpe.vocabulary(PATH))
    return [done.ids[a:b].tolist() for a, b in zip(done.row_ids[:-1], done.row_ids[1:], strict=True)]


ALPHABET = "ab'streovmld  \n\t é漢12½_-😀S<|>"


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(ALPHABET), max_size=40), min_size=1, max_size=8))
def test_same_ids_as_public_library(reference, texts):
    assert ids_of(texts) == [reference.encode_ordinary(t) for t in texts]


def test_long_slices_and_odd_texts(reference):
    texts = ["a" * 5000, " " * 3000 + "x", "ab" * 3000, "'" * 100, "", "x\n\n", "it's we'll I'M 's", "<|endoftext|>", None]
    assert ids_of(texts) == [reference.encode_ordinary(t or "") for t in texts]


def test_scan_is_the_composition_of_all_before():
    rng = np.random.default_rng(0)
    functions = rng.integers(0, 256, 1000).astype(np.uint8)
    state, seen = 0, []
    for f in functions.tolist():
        seen.append(state)
        state = f >> 2 * state & 3
    assert (bpe.scan(functions) & 3).tolist() == seen


def test_columns_round_trip(odd):
    coded = bpe.encode(odd, PATH, starts="at", exact="same")
    back = bpe.decode(coded, PATH).collect()
    assert len(back) == 12 and set(odd.columns) <= set(coded.columns)
    tokens = bpe.vocabulary(PATH).tokens
    for r in back:
        assert r.decoded == (r.text or "") and r.same
        at = 0
        for i, start in zip(r.token_ids, r["at"], strict=True):
            assert start == at
            at += len(tokens[i])


def test_digests(reference, odd, empty):
    for r in bpe.digests(odd, PATH).join(odd.select("doc_id", "text").distinct(), "doc_id").where("doc_id <> 7").collect():
        ids = reference.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.digests(empty, PATH).count() == 0


def test_strings_of_ids_are_laid_out_at_once():
    strings = bpe.Strings([b"a", b"", b"bcd", b"\xff\x00"])
    ids = np.array([2, 0, 1, 3, 3, 2])
    joined, at = strings.join(ids, np.array([0, 2, 2, 3, 6, 6]))
    assert bytes(joined) == b"bcda\xff\x00\xff\x00bcd" and at == [0, 4, 4, 4, 11, 11]
    assert bytes(strings.join(ids[:0], np.array([0, 0]))[0]) == b""
    vocab = bpe.vocabulary(PATH)
    some = vocab.encode_slices([b"a", b"xqzv", b"a"])
    assert some[0] == some[2] and vocab.decode(list(some[1])) == b"xqzv"


def test_a_worker_works_on_little_at_once():
    """What a task needs beside its rows follows the piece it works on; what it held goes back when it is over."""
    vocab, rng = bpe.vocabulary(PATH), np.random.default_rng(5)
    words = np.array(["".join(w) for w in rng.choice(list("abcdefgh"), (30_000, 7))])
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(600)), "text": [" ".join(rng.choice(words, 1000)) for _ in range(600)]})
    work = bpe._digests(PATH)
    list(work(iter([batch.slice(0, 2)])))
    tracemalloc.start()
    rows = sum(b.num_rows for b in work(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 600 and peak < 50 << 20 and not vocab.cache
