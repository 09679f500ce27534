import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from acctlens.llm import bpe
from acctlens.llm.bpe import Tokenizer, Utf8Machine, bpe_digests, read_ranks, tokenised
from acctlens.llm.queries import tokenizer_files
from tests.llm.helpers import documents, edge_rows

PATH, PATTERN = tokenizer_files()


@pytest.fixture(scope="module")
def both():
    ranks = read_ranks(PATH)
    return Tokenizer(ranks, PATTERN), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(both, text):
    ours, theirs = both
    ids = ours.encode(text)
    assert list(ids) == theirs.encode_ordinary(text)
    assert b"".join(ours.decode(ids)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9000, "=" * 9000, " " * 9000, "中" * 5000, "é" * 5000, "x1" * 3000,
                                  "it's we'll THEY'RE  \x1c \x85 \xa0 ² ½ Ⅷ ٣"])
def test_long_splits_and_rare_classes(both, text):
    ours, theirs = both
    assert list(ours.encode(text)) == theirs.encode_ordinary(text)


def test_random_pieces(both):
    ours, theirs = both
    r = random.Random(4)
    parts = ["the", "and", "ing", "tion", " ", "  ", "\n", "'s", "123", "!!", "é", "ß", "🎉", "Th", "qq", "-", "==", "ndor"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(1, 25)))
        assert list(ours.encode(text)) == theirs.encode_ordinary(text)


@pytest.mark.parametrize("cut", [1, 2, 3, 5])
def test_utf8_machine_passes_whole_characters(cut):
    data = "aé中🎉b".encode() * 3 + b"\xff\x80\xe4"
    m = Utf8Machine()
    chunks = [m.feed(data[i: i + cut]) for i in range(0, len(data), cut)]
    assert b"".join(chunks) + m.held == data
    assert "".join(c.decode("utf-8", "replace") for c in chunks).startswith("aé中🎉b" * 3)


def test_digests(spark, both):
    rows = edge_rows()
    got = sorted((tuple(r) for r in bpe_digests(documents(spark, rows, clash=True), PATH, PATTERN).collect()), key=str)
    want = []
    for d, t in rows:
        ids = both[1].encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe_digests(documents(spark, []), PATH, PATTERN).collect() == []


def test_tokenised_keeps_other_columns(spark, both):
    rows = tokenised(documents(spark, edge_rows()), PATH, PATTERN).collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) and r.source == "s" for r in rows)


def test_states_that_are_dropped_are_freed_without_the_collector():
    """Tasks run with gc off; states lead to each other in circles, and a reset has to undo those."""
    import gc
    import weakref

    class Seen(bpe.State):
        __slots__ = ("__weakref__",)

    before = bpe.State
    bpe.State, was = Seen, gc.isenabled()
    gc.disable()
    try:
        machine = bpe.Transducer({bytes((i,)): i for i in range(256)} | {b"ab": 256, b"abab": 257})
        machine.encode(b"abcabcababc")
        dropped = [weakref.ref(s) for s in machine.states.values()]
        assert len(dropped) > 2
        machine._reset()
        assert not any(r() for r in dropped)
        assert machine.encode(b"ababc") == [257, ord("c")]
    finally:
        bpe.State = before
        if was:
            gc.enable()
