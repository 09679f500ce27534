"""Toxicity scores on text restored through a noisy channel.

Writers hide words: digits and signs for letters, letters set apart, letters
drawn out.  A token that looks so becomes a lattice of the letters each sign may stand
for, of runs cut to one or two letters, and, in text set apart, of word breaks.
Viterbi decoding picks the likeliest path under a character trigram model; scores
are made on the restored words.

The character model is counted over all documents, in a table of fixed size
(27 symbols cubed).  Words and word beginnings that speak for label 1 are found by
their likelihood ratio among at most ``LABELLED`` labelled rows (a documented
bound) outside the held-out fold, and a logistic model weighs a document's sum
of evidence against its length.  Labels, lang, source and doc_id enter no score.
"""

from __future__ import annotations

import gc
import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.common import stored
from acctlens.llm.linear import Logistic
from acctlens.llm.quality import held_out

LABELLED = 16_384
KEPT = 300_000
SYMBOLS = 27  # 0: a word's edge, 1-26: letters without accents

#: Letters that a digit or sign may stand for.
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e", "£": "l"}
SIGN_COST, CUT_COST, BREAK_COST = 0.7, 0.4, 2.0
SET_APART = re.compile(r"(?<![^\W_])[^\W_@$!|+](?:[ .*_\-][^\W_]){2,}(?![^\W_])|(?<!\S)[^\W_@$](?:[ .*_\-][\w@$!|+]){3,}(?!\S)")
DRAWN_OUT = re.compile(r"(.)\1\1")
LETTERS = re.compile(r"[^\W\d_]+")


def symbol(letter: str) -> int:
    """1-26 for a Latin letter with or without accents, else 0."""
    base = unicodedata.normalize("NFD", letter)[0]
    return ord(base) - 96 if "a" <= base <= "z" else 0


class Memo(dict):
    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


# ---- character model -----------------------------------------------------------------

def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over the words of all documents, SYMBOLS^3 numbers."""
    def run(batches):
        folded = Memo(lambda w: np.array([0, 0, *map(symbol, w), 0]), KEPT // 3)
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for rb in batches:
            seen: Counter[str] = Counter()
            for text in rb.column(0):
                seen.update(LETTERS.findall((text.as_py() or "").lower()))
            words = list(seen)
            for k in range(0, len(words), 50_000):
                part = words[k: k + 50_000]
                codes = [folded[w] for w in part]
                sizes = np.array([len(c) for c in codes])
                flat = np.concatenate(codes)
                times = np.repeat([seen[w] for w in part], sizes)
                ends = np.zeros(len(flat), bool)
                ends[np.cumsum(sizes) - 1] = True
                ok = ~(ends[:-2] | ends[1:-1])
                tri = (flat[:-2] * SYMBOLS + flat[1:-1]) * SYMBOLS + flat[2:]
                total += np.bincount(tri[ok], times[:-2][ok], SYMBOLS ** 3).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["tri", "n"])

    counted = docs.select("text").mapInArrow(run, "tri int, n long").groupBy("tri").agg(F.sum("n").alias("n"))
    table = counted.toArrow()  # at most SYMBOLS^3 rows
    out = np.zeros(SYMBOLS ** 3)
    out[table.column(0).to_numpy()] = table.column(1).to_numpy()
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


class Restorer:
    """Viterbi decoding of lattices under the character model."""

    def __init__(self, counts: np.ndarray):
        self.cost = (-np.log((counts + 0.1) / (counts.sum(axis=2, keepdims=True) + 0.1 * SYMBOLS))).tolist()

    @staticmethod
    def lattice(noisy: str, apart: bool) -> list[list[tuple[str, float]]]:
        """For each step the letters it may add, with their costs."""
        steps = []
        for m in re.finditer(r"(.)\1*", noisy):
            c, n = m[1], len(m[0])
            options = [(x, SIGN_COST) for x in STANDS_FOR.get(c, "")] or [(c, 0.0)]
            if n >= 3:
                steps.append([(x * k, cost + CUT_COST) for x, cost in options for k in (1, 2)])
            else:
                steps.extend([options] * n)
        if apart:  # a word may begin at each step
            steps = [s + [(" " + x, cost + BREAK_COST) for x, cost in s] if i else s for i, s in enumerate(steps)]
        return steps

    def restore(self, noisy: str, apart: bool = False) -> str:
        paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        fixed = ""
        for step in self.lattice(noisy, apart):
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (p, q), (cost, text) in paths.items():
                for letters, more in step:
                    a, b, total = p, q, cost + more
                    for x in letters:
                        s = symbol(x) if x != " " else 0
                        total += self.cost[a][b][s]
                        a, b = (b, s) if s or x != " " else (0, 0)
                    if (a, b) not in after or total < after[a, b][0]:
                        after[a, b] = total, text + letters
            paths = after
            if len(paths) == 1:  # all that is behind is settled
                (key, (cost, text)), = paths.items()
                fixed += text
                paths = {key: (cost, "")}
        return fixed + min((cost + self.cost[p][q][0], text) for (p, q), (cost, text) in paths.items())[1]

    def words(self, token: str) -> list[str]:
        """The words in a lower-case token of non-space characters."""
        head = 0
        while head < len(token) and not (token[head].isalnum() or token[head] in "@$€£" and token[head + 1: head + 2].isalpha()):
            head += 1
        tail = len(token)
        while tail > head and not token[tail - 1].isalnum():
            tail -= 1
        core = token[head:tail]
        if core.isalpha():
            return [self.restore(core)] if DRAWN_OUT.search(core) else [core]
        if not any(map(str.isalpha, core)):
            return []
        out = []
        for part in re.split(r"[^\w@$!|+€£]|_", core):
            part = part.strip("!|+")
            if part.isalpha() and not DRAWN_OUT.search(part):
                out.append(part)
            elif any(map(str.isalpha, part)):
                out.extend(LETTERS.findall(self.restore(part)))
        return out

    def set_apart(self, text: str) -> list[str]:
        """Words whose letters stand alone, as in ``w o r d``."""
        out = []
        for m in SET_APART.finditer(text):
            joined = "".join(c for c in m[0] if c not in " .*_-")
            if any(map(str.isalpha, joined)):
                out.extend(LETTERS.findall(self.restore(joined, apart=True)))
        return out


# ---- evidence ---------------------------------------------------------------------------

def beginnings(word: str) -> list[str]:
    """A word's features: itself and its first three to seven letters."""
    return [word, *[f"{word[:n]}*" for n in range(3, min(8, len(word)))]]


def train_rows(labels: DataFrame, most: int) -> DataFrame:
    known = (labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg(F.min("toxic").alias("y"), F.max("toxic").alias("y2")).filter("y = y2"))
    return known.filter(~held_out()).orderBy(F.xxhash64(F.lit(23), "doc_id"), "doc_id").limit(most).select("doc_id", "y")


def learn_evidence(texts: DataFrame, restorer: Restorer) -> dict[str, float]:
    """Feature -> log-odds, from (text, y); only features whose likelihood
    ratio beats what chance gives among that many features."""
    def run(batches):
        for rb in batches:
            found: dict[str, list[int]] = {"": [0, 0]}
            memo = Memo(lambda t: [f for w in restorer.words(t) for f in beginnings(w)], KEPT // 3)
            for text, y in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                low = (text or "").lower()
                features = {f for t in set(low.split()) for f in memo[t]}
                features.update(f for w in restorer.set_apart(low) for f in beginnings(w))
                features.add("")
                for f in features:
                    found.setdefault(f, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([v[0] for v in found.values()], pa.int64()),
                                              pa.array([v[1] for v in found.values()], pa.int64())], names=["f", "n0", "n1"])

    counted = texts.select("text", F.col("y").cast("int")).mapInArrow(run, "f string, n0 long, n1 long").groupBy("f").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).filter("f = '' or n1 >= 3")
    counted = stored(counted, "toxic_evidence")
    docs = counted.filter("f = ''").first()
    if not docs or not docs["n0"] or not docs["n1"]:
        return {}
    base = docs["n1"] / (docs["n0"] + docs["n1"])
    n0, n1 = F.col("n0"), F.col("n1")
    share = n1 / (n0 + n1)
    gain = n1 * F.log(share / base) + F.when(n0 > 0, n0 * F.log((1 - share) / (1 - base))).otherwise(0.0)
    odds = F.log((n1 + 0.5) / (docs["n1"] + 1) * (docs["n0"] + 1) / (n0 + 0.5))
    # what passes is bounded by the labelled rows
    passed = counted.filter("f <> ''").filter((share > base) & (gain > 14) & (odds > 2)).select("f", odds.alias("odds")).toArrow()
    return dict(zip(passed.column(0).to_pylist(), passed.column(1).to_pylist()))


class ToxicityModel:
    def __init__(self, restorer: Restorer, evidence: dict[str, float]):
        self.restorer, self.evidence = restorer, evidence
        self.logistic: Logistic | None = None

    def weight(self, token: str) -> float:
        get = self.evidence.get
        return max((get(f, 0.0) for w in self.restorer.words(token) for f in beginnings(w)), default=0.0)

    def reader(self):
        """text -> inputs of the logistic model; remembers tokens."""
        memo = Memo(self.weight, KEPT)
        get = self.evidence.get

        def read(text: str) -> list[float]:
            low = text.lower()
            tokens = low.split()
            total = sum(map(memo.__getitem__, tokens))
            for w in self.restorer.set_apart(low):
                total += max(get(f, 0.0) for f in beginnings(w))
            n = len(tokens)
            return [math.log1p(total), math.log1p(100 * total / (n + 1)), math.log1p(n), float(total > 0)]

        return read


def fit_toxicity(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> ToxicityModel:
    restorer = Restorer(character_counts(docs))
    train = train_rows(labels, labelled)
    texts = docs.select("doc_id", "text").join(F.broadcast(train), "doc_id")  # at most ``labelled`` rows
    model = ToxicityModel(restorer, learn_evidence(texts, restorer))

    def inputs(batches):
        read = model.reader()
        for rb in batches:
            x = [read(t or "") for t in rb.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), rb.column(1).cast(pa.int32())], names=["x", "y"])

    got = texts.select("text", "y").mapInArrow(inputs, "x array<double>, y int").toArrow()
    x = np.array(got.column(0).to_pylist(), float).reshape(got.num_rows, 4)
    y = np.array(got.column(1).to_pylist(), float)
    order = np.lexsort((y, *x.T)) if len(x) else np.zeros(0, int)
    if len(y) and y.min() < y.max():
        model.logistic = Logistic(ridge=0.1).fit(x[order], y[order])
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null text counts as empty; an empty text gets the score of no evidence.
    Labels that are null or contradict each other are left out; without
    labels of both kinds every score is 0.  Repeated rows repeat; a null doc_id
    stays (not held out); empty table: empty result; other columns are not
    read.
    """
    model = fit_toxicity(docs, labels, labelled)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        gc.disable()  # large memories without cycles
        try:
            read = model.reader()
            for rb in batches:
                x = np.array([read(t.as_py() or "") for t in rb.column(1)]).reshape(rb.num_rows, 4)
                score = model.logistic.predict(x) if model.logistic else np.zeros(rb.num_rows)
                yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(score, pa.float64())], schema=schema)
        finally:
            gc.enable()

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
