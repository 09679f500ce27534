"""One text of some 20 MB between ordinary ones, through the operators that read whole texts."""

import hashlib
import zlib

import numpy as np
import pytest
import tiktoken

from acctlens.llm.bpe import bpe_digests, read_ranks
from acctlens.llm.merkle import merkle_manifest
from acctlens.llm.queries import tokenizer_files
from acctlens.llm.simhash import simhash_groups
from acctlens.llm.suffixes import suffix_dedup
from tests.llm.helpers import brute_fingerprint, documents, prose

SHARED = "This passage of more than fifty bytes stands in both of the texts. "


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(0)
    words = np.array([f"w{i}x{i * 7919 % 1000}" for i in range(200_000)])
    long = " ".join(words[rng.integers(0, len(words), 2_000_000)])
    assert len(long) > 19 << 20
    return {1: SHARED + prose(1, 50), 2: long[:10_000_000] + " " + SHARED + long[10_000_000:], 3: prose(2, 40)}


@pytest.fixture(scope="module")
def docs(spark, texts):
    return documents(spark, list(texts.items())).coalesce(1)


def test_simhash(docs, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_groups(docs).collect()}
    assert got == {d: (f"{brute_fingerprint(t):016x}", d) for d, t in texts.items()}


def test_byte_bpe(docs, texts):
    path, pattern = tokenizer_files()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    for r in bpe_digests(docs, path, pattern).collect():
        ids = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_suffix_dedup(docs, texts):
    """The long text loses the shared passage; the space before it is in no earlier text."""
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup(docs).collect()}
    kept = {d: t.replace(SHARED, "") if d == 2 else t for d, t in texts.items()}
    assert got == {d: (len(t), len(t) - len(kept[d]), int(d == 2), hashlib.sha256(kept[d].encode()).hexdigest()) for d, t in texts.items()}


def test_merkle(docs, texts):
    for r in merkle_manifest(docs).collect():
        t = texts[r.doc_id]
        fields = (r.doc_id, "s", "en", len(t), t)
        assert r.leaf == hashlib.sha256("".join(f"{len(str(v).encode())}:{v}" for v in fields).encode()).hexdigest()
        lowered = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and t != t.lower()
        assert r.verified != lowered
