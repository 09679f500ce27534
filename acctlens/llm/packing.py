"""Packing token sequences by patterns from non-negative least squares.

1. Texts become ids, cut into pieces of at most ``capacity`` tokens.
2. The histogram of piece lengths - at most ``capacity`` numbers, however many
   documents there are - is what the plan is made from, on the driver.
3. Lengths fall into classes.  A pattern is a few classes that fill a sequence; all
   patterns are enumerated, and repeat counts are fitted to the histogram by
   non-negative least squares (active sets), rounded, and filled with
   exact lengths.
4. What is left is packed best-fit, longest first, into the space that
   patterns leave, then into new sequences, on whole runs of equal lengths and
   equal spaces, so the work is bounded by ``capacity`` too.
5. A piece finds its place by its length and its rank among pieces of that
   length: counts per task are added up by Spark, and the plan, bounded by
   ``capacity``, goes to the tasks.
"""

from __future__ import annotations

import bisect
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctlens.llm.common import batch, stored

END_ID = 1
#: Classes of lengths and the most pieces in a pattern.
CLASSES = 128
PARTS = 3
#: A class counts for less in the fit the shorter it is: short pieces fill gaps anyhow.
LEAST_WEIGHT = 0.1

#: ASCII white space always separates words of this tokenizer, so ids of a text are those of its parts; so does
#: the edge between letters and marks behind them.
MARKS = ".,;:!?"
SPACE = re.compile(rb"[\x20\x09-\x0D]")
WORD_END = "</w>"
#: The tokenizer is blind to case, but for its special tokens and letters that a combining mark (U+0300 on) follows.
CASE_COUNTS = ("<|", "[\u0300-\u036f]")
MEMO_PARTS = 700_000
LONG_PART = 64
TEXT_SLICE = 4 << 20

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids", pa.binary())])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids binary"


# ---- texts to pieces ---------------------------------------------------------------
class Ids:
    """Ids of texts by a tokenizers file.

    Splitting, finding the distinct parts of a slice of texts and putting their ids
    in place are array operations; Python sees each distinct part of a slice once.  Parts are
    remembered up to ``MEMO_PARTS``; those over ``LONG_PART`` characters never are."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for words of ASCII letters in lower case, which the normaliser leaves as they are and white space separates
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.memo: dict[str, bytes] = {"": b""}
        self.marks: dict[str, bytes] = {"": b""}

    def one(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def behind(self, marks: str) -> bytes:
        """Ids of a run of marks."""
        if marks not in self.marks:
            if len(marks) > LONG_PART:
                return self.one(marks)
            if len(self.marks) > MEMO_PARTS // 100:
                self.marks.clear()
            self.marks[marks] = self.one(marks)
        return self.marks[marks]

    def encode(self, parts: list[str]) -> dict[str, bytes]:
        """Letters are one word to the tokenizer, so many words are encoded as one
        text and told apart by the tokens that end a word; marks behind them
        add their own ids; other parts are texts of their own."""
        out: dict[str, bytes] = {}
        words: dict[str, list[str]] = {}
        rest, memo = [], self.memo
        for p in parts:
            w = p.rstrip(MARKS)
            if not w.isalpha():
                rest.append(p)
            elif w in memo:
                out[p] = memo[w] + self.behind(p[len(w):])
            else:
                words.setdefault(w, []).append(p)
        if len(memo) + len(words) + len(rest) > MEMO_PARTS:
            memo.clear()
            memo[""] = b""
        # lower case and no letter beyond Latin-1: nothing for the normaliser to do
        plain = [w for w in words if w.islower() and (w.isascii() or max(w) < "\u0100")]
        for some, tokenizer in ((plain, self.plain), (list(words.keys() - plain), self.tokenizer)):
            if not some:
                continue
            ids = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) != len(some):
                rest += [p for w in some for p in words[w]]
                continue
            data, begin = ids.tobytes(), 0
            for w, end in zip(some, ends):
                own = data[begin:end]
                begin = end
                if len(w) <= LONG_PART:
                    memo[w] = own
                for p in words[w]:
                    out[p] = own if p is w else own + self.behind(p[len(w):])
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else []
        for p, e in zip(rest, found):
            out[p] = np.array(e.ids, "<u4").tobytes()
            if len(p) <= LONG_PART:
                memo[p] = out[p]
        return out

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts behind each other, how many each has); no nulls."""
        keep = pc.or_(pc.match_substring(texts, CASE_COUNTS[0]), pc.match_substring_regex(texts, CASE_COUNTS[1]))
        parts = pc.ascii_split_whitespace(pc.if_else(keep, texts, pc.ascii_lower(texts)))
        in_text = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        distinct, at = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        ids = list(map(self.memo.get, distinct))
        new = self.encode([p for p, i in zip(distinct, ids) if i is None])
        ids = [i if i is not None else new[p] for p, i in zip(distinct, ids)]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin = np.cumsum(size) - size
        many = size[at]
        after = np.cumsum(many)
        where = np.repeat(begin[at] - (after - many), many)
        where += np.arange(len(where))
        total = np.concatenate([[0], after])[np.concatenate([[0], np.cumsum(in_text)])]
        return np.frombuffer(b"".join(ids), "<u4")[where], np.diff(total)

    def of_long(self, text: bytes) -> Iterator[np.ndarray]:
        """Ids of a text, some of it at a time."""
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > TEXT_SLICE:  # cut before white space, so that no part is cut
                m = SPACE.search(text, at + TEXT_SLICE)
                end = m.start() if m else end
            yield self.of(pa.array([text[at:end].decode()], pa.large_string()))[0]
            at = end


#: One for each file and Python process: tasks that follow each other share what is remembered.
_IDS: dict[str, Ids] = {}


def ids_by(path: str) -> Ids:
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


def pieces_of(ids: np.ndarray, counts: np.ndarray, doc_ids: pa.Array, capacity: int) -> pa.RecordBatch:
    """PIECES rows of documents that have ``counts`` ids each; END_ID is put behind them."""
    length = counts + 1
    whole = np.full(len(ids) + len(counts), END_ID, "<u4")
    whole[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    pieces = -(-length // capacity)
    doc = np.repeat(np.arange(len(counts)), pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    own = np.minimum(capacity, length[doc] - piece * capacity)
    ends = 4 * np.concatenate([[0], np.cumsum(own)]).astype(np.int32)
    binary = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(whole)])
    return pa.RecordBatch.from_arrays([doc_ids.take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()),
                                       pa.array(own, pa.int64()), binary], schema=PIECES)


def long_pieces(ids: Iterable[np.ndarray], doc_id: int | None, capacity: int) -> Iterator[pa.RecordBatch]:
    """PIECES rows of one document, some at a time."""
    rest, start = np.zeros(0, "<u4"), 0
    for some in chain(ids, [np.array([END_ID], "<u4")]):
        rest = np.concatenate([rest, some])
        n = (len(rest) - 1) // capacity       # the last piece waits for the end
        for k in range(n):
            yield _piece(doc_id, start, rest[k * capacity: (k + 1) * capacity], capacity)
            start += capacity
        rest = rest[n * capacity:]
    yield _piece(doc_id, start, rest, capacity)


def _piece(doc_id: int | None, start: int, ids: np.ndarray, capacity: int) -> pa.RecordBatch:
    return batch(PIECES, [[doc_id], [start // capacity], [start], [len(ids)], [ids.tobytes()]])


def slices(rb: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(doc_ids, texts) of a batch by up to ``TEXT_SLICE`` bytes; a longer text is alone."""
    texts = pc.fill_null(rb.column(1).cast(pa.large_string()), "")
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < rb.num_rows:
        before = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + TEXT_SLICE, side="right")))
        yield rb.column(0).slice(at, end - at), texts.slice(at, end - at)
        at = end


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = 4096) -> DataFrame:
    """(doc_id, piece, start, length, ids): each document's ids (little-endian unsigned
    32-bit integers) and END_ID, those of over ``capacity`` tokens cut into pieces of that many.

    A null text counts as empty and gives END_ID alone.  Texts are
    encoded whole, some MB at a time; a part without white space is held whole."""

    def run(batches):
        ids = ids_by(tokenizer_file)
        for rb in batches:
            for doc_ids, texts in slices(rb):
                if len(texts) == 1 and pc.binary_length(texts)[0].as_py() > TEXT_SLICE:
                    yield from long_pieces(ids.of_long(texts[0].as_py().encode()), doc_ids[0].as_py(), capacity)
                else:
                    yield pieces_of(*ids.of(texts), doc_ids, capacity)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES_DDL)


# ---- the plan ----------------------------------------------------------------------
def patterns(classes: int, parts: int) -> list[tuple[int, ...]]:
    """Every choice of 1 to ``parts`` classes, largest first, that adds up to
    ``classes``: the few-document patterns that fill a sequence."""
    out: list[tuple[int, ...]] = []

    def grow(chosen: tuple[int, ...], left: int):
        if left == 0:
            out.append(chosen)
        elif len(chosen) < parts:
            for c in range(min(left, chosen[-1] if chosen else classes), 0, -1):
                if c * (parts - len(chosen)) < left:
                    break
                grow((*chosen, c), left - c)

    grow((), classes)
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """argmin |a x - b| over x >= 0, by Lawson and Hanson's active sets."""
    n = a.shape[1]
    x, inside = np.zeros(n), np.zeros(n, bool)
    gram, against = a.T @ a, a.T @ b
    limit = 1e-9 * max(1.0, np.abs(against).max(initial=0.0))
    for _ in range(rounds or 3 * len(b)):
        pull = against - gram @ x
        pull[inside] = -np.inf
        j = int(np.argmax(pull))
        if pull[j] <= limit:
            break
        inside[j] = True
        while True:
            at = np.flatnonzero(inside)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            bad = s <= 1e-12
            if not bad.any():
                x[:] = 0
                x[at] = s
                break
            old = x[at]
            move = np.min(old[bad] / np.maximum(old[bad] - s[bad], 1e-300))
            x[at] = old + move * (s - old)
            gone = at[bad & (x[at] <= 1e-12)]
            if not len(gone):
                gone = at[bad][:1]
            x[gone] = 0
            inside[gone] = False
            if not inside.any():
                break
    return x


class Plan:
    """Rows (length, from rank, copies in a sequence, first sequence, sequences,
    offset): pieces of ``length`` from that rank on lie in that many sequences,
    ``copies`` in each, one behind the other from ``offset`` on."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.next_rank: dict[int, int] = {}
        self.spaces: list[int] = []                          # free tokens, ascending
        self.open: dict[int, list[tuple[int, int]]] = {}     # free tokens -> runs of sequences

    def put(self, length: int, copies: int, first: int, count: int, offset: int):
        rank = self.next_rank.get(length, 0)
        self.rows.append((length, rank, copies, first, count, offset))
        self.next_rank[length] = rank + copies * count

    def leave(self, free: int, first: int, count: int):
        if count and free:
            if free not in self.open:
                bisect.insort(self.spaces, free)
                self.open[free] = []
            self.open[free].append((first, count))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """The run of sequences with the smallest free space of ``least`` at least."""
        at = bisect.bisect_left(self.spaces, least)
        if at == len(self.spaces):
            return None
        free = self.spaces[at]
        first, count = self.open[free].pop()
        if not self.open[free]:
            del self.open[free]
            del self.spaces[at]
        return free, first, count

    def best_fit(self, length: int, count: int):
        """``count`` pieces of ``length``, each into the smallest space that holds it."""
        while count:
            free, first, run = self.take(length) or (self.capacity, self.sequences, 0)
            copies = free // length
            if not run:  # no space: new sequences, as many as are filled by whole copies, or one
                run = max(1, count // copies)
                self.sequences += run
            offset = self.capacity - free
            if count >= copies:
                use = min(run, count // copies)
            else:
                use, copies = 1, count
            self.put(length, copies, first, use, offset)
            count -= use * copies
            self.leave(free - copies * length, first, use)
            self.leave(free, first + use, run - use)


def class_of(length: np.ndarray | int, capacity: int, classes: int):
    """Class of a length: how many ``capacity / classes`` units hold it."""
    return -(-length * classes // capacity)


def pattern_counts(histogram: np.ndarray, capacity: int, classes: int = CLASSES,
                   parts: int = PARTS) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) fitted to the histogram and rounded; never more than
    there are pieces."""
    classes = min(classes, capacity)
    shapes = patterns(classes, parts)
    have = np.bincount(class_of(np.arange(capacity + 1), capacity, classes), histogram, classes + 1)[1:]
    a = np.zeros((classes, len(shapes)))
    for j, shape in enumerate(shapes):
        for c in shape:
            a[c - 1, j] += 1
    weight = np.maximum(LEAST_WEIGHT, np.arange(1, classes + 1) / classes)
    scale = max(1.0, have.max(initial=0.0))
    x = nnls(a * weight[:, None], have / scale * weight) * scale
    left, out = have.astype(np.int64), []
    for j in sorted(np.flatnonzero(x > 0.5 / len(shapes)), key=lambda j: (len(shapes[j]), -shapes[j][0])):
        need = np.bincount(np.array(shapes[j]) - 1, minlength=classes)
        n = min(int(round(x[j])), int((left[need > 0] // need[need > 0]).min()))
        if n > 0:
            left -= n * need
            out.append((shapes[j], n))
    return out


def plan(histogram: np.ndarray, capacity: int) -> Plan:
    """``histogram[l]`` pieces of each length l from 1 to ``capacity``."""
    p = Plan(capacity)
    left = histogram.astype(np.int64).copy()
    classes = min(CLASSES, capacity)
    of = class_of(np.arange(capacity + 1), capacity, classes)
    longest: dict[int, int] = {}
    for length in range(1, capacity + 1):
        if left[length]:
            longest[int(of[length])] = length
    for shape, n in pattern_counts(histogram, capacity):
        while n:
            # the longest lengths left of each class, and how many repeats have just those
            chosen: list[int] = []
            taken: dict[int, int] = {}
            for c in shape:
                length = longest[c]
                while left[length] - taken.get(length, 0) <= 0:
                    length -= 1
                chosen.append(length)
                taken[length] = taken.get(length, 0) + 1
            run = min(n, *(int(left[x]) // k for x, k in taken.items()))
            offset = 0
            for length in chosen:
                p.put(length, 1, p.sequences, run, offset)
                offset += length
                left[length] -= run
            p.leave(capacity - offset, p.sequences, run)
            p.sequences += run
            n -= run
    for length in range(capacity, 0, -1):
        p.best_fit(length, int(left[length]))
    return p


# ---- places ------------------------------------------------------------------------
PLACE = [("sequence_id", pa.int64()), ("offset", pa.int64())]


def placed(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to rows that have a ``length`` from 1 to
    ``capacity``; what other columns there are goes along.

    Pieces of one length are ranked by one small row a task and length, so a length that a
    third of all rows share is spread like any other.  Which of equally long
    rows gets which place follows the order in which they were written down."""
    spark = pieces.sparkSession
    names = pieces.columns
    at = F.monotonically_increasing_id()
    rows = stored(pieces.select(*[F.col(c).alias(f"c_{c}") for c in names], at.alias("_at")), "packing_pieces")
    part = F.shiftright("_at", 33).alias("_part")
    in_task = Window.partitionBy("_part", "c_length").orderBy("_at")
    counts = stored(rows.groupBy(part, "c_length").agg(F.count(F.lit(1)).alias("_n")), "packing_counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("c_length").agg(F.sum("_n")).collect():  # capacity rows at most
        if length is None or not 1 <= length <= capacity:
            raise ValueError(f"a piece of length {length}; lengths are 1 to {capacity}")
        histogram[length] = n
    p = plan(histogram, capacity)
    table = np.array(sorted(p.rows), np.int64).reshape(-1, 6)
    known = table[:, 0] * (1 << 44) + table[:, 1]

    before = Window.partitionBy("c_length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", "c_length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = (rows.withColumn("_part", part).join(counts.hint("shuffle_hash"), ["_part", "c_length"])
              .withColumn("_rank", F.col("_before") + F.row_number().over(in_task) - 1))

    def run(batches):
        for rb in batches:
            length, rank = (rb.column(rb.schema.get_field_index(c)).to_numpy() for c in ("c_length", "_rank"))
            row = table[np.searchsorted(known, length.astype(np.int64) * (1 << 44) + rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence, place = row[:, 3] + nth // row[:, 2], row[:, 5] + nth % row[:, 2] * length
            yield pa.RecordBatch.from_arrays(
                [*(rb.column(i) for i in range(len(names))), pa.array(sequence, pa.int64()), pa.array(place, pa.int64())],
                names=[*names, "sequence_id", "offset"])

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.select(*[f"c_{c}" for c in names], "_rank").mapInArrow(run, schema)
