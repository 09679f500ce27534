"""Byte-level BPE with a lazily determinised transducer, and streaming decode.

A token sequence is the BPE encoding of its bytes exactly when each pair of
neighbours encodes to itself.  So while bytes arrive, every prefix has one last
token: the one that ends there and gets on with the last token of the
prefix before it.  The transducer's state holds the live positions, those from
which a token may still reach beyond the end: the bytes since each, and the
last token before it.  A step emits the last token of the prefix.  Going back from
the end gives the tokens; in a long split, all live positions soon share
their way back, so what they share is final after a lookahead bounded by the
longest token, and is passed on.  States and steps are made when first needed.

Splits by the pre-tokenizer's pattern are independent, so each distinct split
goes through the transducer once per worker; memories are cleared when full.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLITS_KEPT, LONGEST_KEPT, STATES_KEPT, PAIRS_KEPT = 200_000, 64, 200_000, 400_000
LOOKBACK, LISTED = 4096, 1 << 22
#: Beyond Latin-1, or a number or separator of it that is no digit or white space to all.
OUTSIDE = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0100-\U0010ffff]").search
BYTES = [bytes((i,)) for i in range(256)]
TOKENS_AT_ONCE, ROWS_AT_ONCE = 1 << 16, 256

OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                 ("decoded_sha256", pa.string())])


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base 64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class State:
    __slots__ = ("live", "step")

    def __init__(self, live: tuple):
        self.live = live  # ((bytes since, last token before), ...), the longest first
        self.step: dict[int, tuple[State, int]] = {}


class Transducer:
    """Merges -> token ids, one byte at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.length = {i: len(b) for b, i in ranks.items()}
        #: bytes -> (token or None, whether a longer token begins with them, the bytes)
        self.heads: dict[bytes, tuple[int | None, bool, bytes]] = {t: (i, False, t) for t, i in ranks.items()}
        for t in ranks:
            for n in range(len(t)):
                self.heads[t[:n]] = (ranks.get(t[:n]), True, t[:n])
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.states: dict[tuple, State] = {}
        self._reset()

    def _reset(self):
        for s in self.states.values():  # states lead to each other; tasks run without the collector of cycles
            s.step.clear()
        self.start = State(((b"", None),))
        self.states = {self.start.live: self.start}

    def merged(self, data: bytes, below: int) -> list[int]:
        """Plain merging, the lowest rank first, with the ranks under ``below``."""
        parts = [data[i: i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def halved(self, token: int) -> tuple[int, int] | None:
        """The pair whose merge makes ``token``; None for a single byte and
        for a token that merging never makes."""
        if token not in self.halves:
            parts = self.merged(self.bytes_of[token], token)
            self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.halves[token]

    def agree(self, left: int | None, right: int) -> bool:
        """Whether ``left`` and ``right`` encode to themselves side by side.

        Undo the merges of both from the latest back: while the inner ends
        stand there, a merge of the two ends that ranks before the one undone
        last would have come first and taken the boundary away."""
        if len(self.bytes_of[right]) > 1 and self.halved(right) is None:
            return False
        if left is None:
            return True
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(left, right)
        return known

    def _apart(self, a: int, b: int) -> bool:
        ranks, of = self.ranks, self.bytes_of
        before = 1 << 40  # a joint merge of a rank under this comes first
        while True:
            joint = ranks.get(of[a] + of[b])
            if joint is not None and joint < before:
                return False
            in_a, in_b = self.halved(a), self.halved(b)
            if in_a is None and in_b is None:
                return True
            # the later of both merges is undone; of equal ones the right one, as the left one comes first
            if in_b is None or in_a is not None and a > b:
                before, a = a, in_a[1]  # a joint merge of the same rank stands further right
            else:
                before, b = b + 1, in_b[0]  # a joint merge of the same rank stands further left

    def _advance(self, s: State, byte: int) -> tuple[State, int]:
        more, heads, pairs, token, live = BYTES[byte], self.heads, self.pairs, None, []
        for since, last in s.live:  # the longest token first
            head = heads.get(since + more)
            if head is not None:
                ends, goes_on, since = head
                if token is None and ends is not None:
                    known = None if last is None else pairs.get(last << 32 | ends)
                    if known or known is None and self.agree(last, ends):
                        token = ends
                if goes_on:
                    live.append((since, last))
        live.append((b"", token))
        key = tuple(live)
        known = self.states.get(key)
        if known is None:
            known = self.states[key] = State(key)
        s.step[byte] = known, token
        return known, token

    def encode(self, data: bytes) -> list[int]:
        """The ids of one split."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(self.states) > STATES_KEPT:
            self._reset()
        s, ids, lasts = self.start, [], []
        for byte in data:
            s, token = s.step.get(byte) or self._advance(s, byte)
            lasts.append(token)
            if len(lasts) >= LOOKBACK:
                shared = self._shared(s, lasts)
                ids += self._back(lasts, shared)
                del lasts[:shared]
        return ids + self._back(lasts, len(lasts))

    def _back(self, lasts: list[int], at: int) -> list[int]:
        out = []
        while at:
            out.append(lasts[at - 1])
            at -= self.length[out[-1]]
        out.reverse()
        return out

    def _shared(self, s: State, lasts: list[int]) -> int:
        """Where the ways back from all live positions meet."""
        ends = {len(lasts) - len(since) for since, _ in s.live}
        while len(ends) > 1:
            latest = max(ends)
            ends.remove(latest)
            ends.add(latest - self.length[lasts[latest - 1]])
        return ends.pop()


class Splits(dict):
    """Split -> ids, filled by the transducer; two generations, so that what
    is in use outlives a full memory."""

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine, self.older = machine, {}

    def __missing__(self, split: str) -> tuple[int, ...]:
        ids = self.older.get(split)
        if ids is None:
            ids = tuple(self.machine.encode(split.encode()))
        if len(split) <= LONGEST_KEPT:
            if len(self) >= SPLITS_KEPT:
                self.older = dict(self)
                self.clear()
            self[split] = ids
        return ids


class Tokenizer:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.splits = Splits(Transducer(ranks))
        self.pattern = regex.compile(pattern)
        plain = (pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]")
                 .replace(r"\p{N}", r"\d"))
        #: the same for texts in Latin-1 without the characters where the two modules' classes differ
        self.plain = self.pattern if r"\p" in plain else re.compile(plain)
        self.table = self.splits.machine.bytes_of

    def encode(self, text: str) -> array:
        pattern = self.pattern if OUTSIDE(text) else self.plain
        # a list of splits is quicker, but takes many times the text's memory
        splits = pattern.findall(text) if len(text) <= LISTED else (m[0] for m in pattern.finditer(text))
        return array("I", chain.from_iterable(map(self.splits.__getitem__, splits)))

    def decode(self, ids: Iterable[int]) -> Iterator[bytes]:
        """Chunks of bytes, each of whole characters as far as the ids are
        valid UTF-8; what is still open at the end comes last."""
        machine = Utf8Machine()
        for k in range(0, len(ids), TOKENS_AT_ONCE):
            yield machine.feed(b"".join(map(self.table.__getitem__, ids[k: k + TOKENS_AT_ONCE])))
        yield machine.held


#: Continuation bytes that a lead byte calls for.
NEEDS = [0] * 0xC2 + [1] * (0xE0 - 0xC2) + [2] * (0xF0 - 0xE0) + [3] * (0xF5 - 0xF0) + [0] * (256 - 0xF5)


class Utf8Machine:
    """Passes on bytes up to the last whole character and holds the rest, at
    most three bytes; bytes that no character can have pass through."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> bytes:
        data = self.held + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:  # a lead byte, or one byte of its own
                if NEEDS[byte] >= back:
                    cut = len(data) - back
                break
        self.held = data[cut:]
        return data[:cut]


_TOKENIZERS: dict[tuple, Tokenizer] = {}


def _worker_tokenizer(shared) -> Tokenizer:
    """One for each worker process, kept from task to task."""
    raw, pattern = shared.value
    key = (hash(raw), pattern)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = Tokenizer({base64.b64decode(a): int(b) for a, b in
                                      (line.split() for line in raw.splitlines() if line.strip())}, pattern)
    return _TOKENIZERS[key]


def _shared(df: DataFrame, ranks_path: str, pattern: str):
    with open(ranks_path, "rb") as f:  # a vocabulary file: its size does not depend on the data
        return df.sparkSession.sparkContext.broadcast((f.read(), pattern))


def tokenised(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The columns of ``docs`` but ``text`` and ``n_chars``, with n_tokens, ids
    (array<int>) and round_trip, whether the ids decode to the text's bytes."""
    shared = _shared(docs, ranks_path, pattern)
    names = [c for c in docs.columns if c not in ("text", "n_chars", "n_tokens", "ids", "round_trip")]
    rows = docs.select(*names, "text")
    schema = rows.drop("text").schema.add("n_tokens", T.LongType()).add("ids", T.ArrayType(T.IntegerType())).add("round_trip", T.BooleanType())

    def run(batches):
        gc.disable()  # memories of tuples: nothing cyclic to find, much to search
        try:
            tok = _worker_tokenizer(shared)
            for rb in (rb.slice(k, ROWS_AT_ONCE) for rb in batches for k in range(0, rb.num_rows, ROWS_AT_ONCE)):
                flat, ends, same = array("I"), [0], []
                for text in rb.column(rb.num_columns - 1):
                    text = text.as_py() or ""
                    ids = tok.encode(text)
                    same.append(b"".join(tok.decode(ids)) == text.encode())
                    flat.extend(ids)
                    ends.append(len(flat))
                offsets = np.array(ends, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(flat, np.uint32).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*rb.columns[:-1], pa.array(np.diff(offsets).astype(np.int64)), lists,
                                                  pa.array(same, pa.bool_())], names=[*names, "n_tokens", "ids", "round_trip"])
        finally:
            gc.enable()

    return rows.mapInArrow(run, schema)


def bpe_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row.

    Null text counts as empty: no tokens, digests of nothing.  A null doc_id
    stays null, repeated rows repeat, an empty table gives an empty result,
    other columns are not read.  Texts of any length go through whole.
    """
    shared = _shared(docs, ranks_path, pattern)

    def run(batches):
        gc.disable()  # memories of tuples: nothing cyclic to find, much to search
        try:
            yield from digests(batches)
        finally:
            gc.enable()

    def digests(batches):
        tok = _worker_tokenizer(shared)
        for rb in batches:
            n, of_ids, of_bytes = [], [], []
            for text in rb.column(1):
                ids = tok.encode(text.as_py() or "")
                decoded = hashlib.sha256()
                for chunk in tok.decode(ids):
                    decoded.update(chunk)
                n.append(len(ids))
                of_ids.append(hashlib.sha256(little_endian(ids)).hexdigest())
                of_bytes.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays([rb.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()),
                                              pa.array(of_bytes, pa.string())], schema=OUT)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def little_endian(ids: array) -> bytes:
    import sys

    if sys.byteorder == "big" or ids.itemsize != 4:
        return b"".join(i.to_bytes(4, "little") for i in ids)
    return ids.tobytes()
