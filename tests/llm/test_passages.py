import random

import numpy as np
import pytest

from acctlens.llm.passages import (AGREE, CHUNK, FEW, HASHES, SPAN, Passages, Stretches, candidates, compact_windows, dealt, firsts,
                                   least_at, packed_entries, passage_classes, spanning, word_hashes)
from tests.llm.helpers import Union, documents, edge_rows, prose


def test_planted_passages(spark):
    passage = prose(77, 60)
    words = passage.split()
    edited = " ".join([*words[:25], "changed", *words[26:]])
    rows = [(1, prose(1, 200)), (2, prose(2, 90) + " " + passage + " " + prose(3, 50)), (3, passage + " " + prose(4, 40)),
            (4, prose(5, 70) + " " + edited), (5, prose(6, 500)), (6, passage.upper()), (7, prose(8, 30) + " " + " ".join(words[:30])),
            (8, None), (9, ""), (10, prose(10, 100)), (11, prose(10, 100)), (11, prose(10, 100)), (None, passage), (12, "same " * 80),
            (13, "same " * 70), (14, prose(14, 9000)), (15, "x " + prose(14, 9000) + " y")]
    got = {r.doc_id: r for r in passage_classes(documents(spark, rows, clash=True).repartition(4)).collect()}
    assert {d: r.class_id for d, r in got.items()} == {2: 2, 3: 2, 4: 2, 6: 2, 10: 10, 11: 10, 12: 12, 13: 12, 14: 14, 15: 14}
    assert all(r.similarity >= 0.8 for r in got.values())
    text = dict((d, t) for d, t in rows if d)
    r = got[3]
    assert text[3].lower().split()[r.start_word: r.start_word + 50] == text[r.partner_id].lower().split()[r.partner_start: r.partner_start + 50]


def test_edge_and_empty_tables(spark):
    got = {r.doc_id: r.class_id for r in passage_classes(documents(spark, edge_rows())).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 10: 4, 11: 11} or got == {1: 1, 2: 1, 3: 1, 4: 4, 10: 4}
    assert passage_classes(documents(spark, [])).collect() == []


def test_compact_windows_are_the_wide_nodes():
    rng = np.random.default_rng(5)
    sizes = [SPAN, SPAN + 1, 200, 60]
    values = np.concatenate([(rng.integers(0, 40, n).astype(np.uint64) << np.uint64(40)) for n in sizes])
    end = np.cumsum(sizes)
    begin = end - sizes
    starts = np.concatenate([np.arange(b, e - SPAN + 1) for b, e in zip(begin, end)])
    got = compact_windows(values, least_at(values, SPAN), starts, begin, end - 1)
    want = []
    for b, e in zip(begin, end):
        for c in range(b, e):
            left = c
            while left > b and values[left - 1] > values[c]:
                left -= 1
            right = c
            while right + 1 < e and values[right + 1] >= values[c]:
                right += 1
            if right - left + 1 >= SPAN:
                want.append((left, c, right))
    assert [tuple(r) for r in got.tolist()] == want


def test_large_groups_are_joined_by_a_forest():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 16, HASHES).astype(np.uint16)
    sign = np.repeat(base[None], 4 * FEW, axis=0)
    sign[np.arange(len(sign)), rng.integers(0, HASHES, len(sign))] = rng.integers(0, 1 << 16, len(sign))
    a, b, n = candidates(sign, np.zeros(len(sign), np.uint32))
    assert len(a) == len(sign) - 1 and (n >= 4).all()
    a, b, n = candidates(sign[:FEW], np.zeros(FEW, np.uint32))  # the same rule in small groups
    assert len(a) == FEW - 1 and (n >= 4).all()
    assert firsts(np.array([3, 3, 4])).tolist() == [True, False, True]


def brute_similarity(a, b):
    """The best of all pairs of passages of two texts."""
    def sets(t):
        w = t.lower().split()
        s = [tuple(w[i: i + 5]) for i in range(len(w) - 4)]
        return [set(s[i: i + SPAN]) for i in range(len(s) - SPAN + 1)]
    return max((len(x & y) / len(x | y) for x in sets(a) for y in sets(b)), default=0.0)


def test_variants_of_one_template_are_classed_as_by_brute_force(spark):
    """Families differ by two words amid the passage (unlike), members of one at its ends (alike)."""
    r = random.Random(11)
    base, rows = prose(500, 50).split(), []
    for f in range(100):
        w = list(base)
        for p in (r.randrange(4, 22), r.randrange(28, 46)):
            w[p] = f"f{f}x{p}"
        for m in range(3):
            rows.append((len(rows), " ".join([f"m{len(rows)}", *w[1:-1], w[-1] if m else f"e{f}"])))
    r.shuffle(rows)
    u = Union()
    for i, (d, t) in enumerate(rows):
        for e, v in rows[:i]:
            if brute_similarity(t, v) >= 0.8:
                u.join(d, e)
    got = {x.doc_id: x.class_id for x in passage_classes(documents(spark, rows).repartition(3)).collect()}
    assert got == {d: u.find(d) for d, _ in rows} and len(set(got.values())) > FEW


def test_runs_of_words_in_different_texts_are_found_at_any_start(spark):
    """Runs of 50 to 52 equal words always, longer ones with changed words nearly always."""
    r = random.Random(12)
    rows, exact, edited = [], set(), set()
    for k in range(600):
        run = prose(10_000 + k, (50, 51, 52, 60)[k % 4]).split()
        other = list(run)
        for p in r.sample(range(60), 2) if len(run) == 60 else ():
            other[p] = f"changed{k}"
        texts = [" ".join([prose(20_000 + 4 * k + s, r.randrange(60)), *w, prose(20_002 + 4 * k + s, r.randrange(60))])
                 for s, w in enumerate((run, other))]
        rows += [(2 * k, texts[0]), (2 * k + 1, texts[1])]
        if len(run) < 60:
            exact.add(2 * k)
        elif brute_similarity(" ".join(run), " ".join(other)) >= 0.8:
            edited.add(2 * k)
    got = {x.doc_id: x for x in passage_classes(documents(spark, rows)).collect()}
    assert all(x.class_id == d // 2 * 2 for d, x in got.items())
    assert exact <= set(got) and all(got[d].similarity == 1 for d in exact)
    assert len(edited) > 50 and len(edited & set(got)) >= 0.95 * len(edited)


def test_slide_equals_brute_force():
    rng = np.random.default_rng(13)
    size = rng.integers(SPAN, 2 * SPAN, 40)
    first = rng.integers(1 - SPAN, 1, 40)
    around = np.stack([first, np.minimum(first + size - SPAN, 0)], 1)
    size = around[:, 1] - around[:, 0] + SPAN
    codes = rng.integers(0, 60, size.sum()).astype(np.uint32)
    s = Stretches(codes, around)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(40), np.arange(40)))
    for i, j, alike, x, y in zip(a, b, *s.slide(a, b)):
        def window(k, at):
            begin = s.begin[k] + at - around[k, 0]
            return set(codes[begin: begin + SPAN].tolist())
        both = range(max(around[i, 0], around[j, 0]), min(around[i, 1], around[j, 1]) + 1)
        want = [len(window(i, o) & window(j, o)) / len(window(i, o) | window(j, o)) for o in both]
        assert not want or alike == max(want)
        assert alike == len(window(i, x) & window(j, y)) / len(window(i, x) | window(j, y))


def test_a_heavy_key_is_spread(spark):
    """Entries go to salts; members to cells in which each two of them meet."""
    text = " ".join(["x", *(prose(30_000, 60) + f" {prose(40_000 + i, 12)}" for i in range(300))]).encode()
    row = {"ids": np.arange(1).tobytes(), "known": np.ones(1, bool).tobytes(), "lens": np.array([len(text)]).tobytes(), "data": text}
    p = Passages(row, 1)
    rows = np.arange(len(p.key))
    salts = {e[1] for e in packed_entries(7, p, rows, np.ones(len(rows), bool), 1)}
    assert len(salts) > 200 and min(salts) > 0
    assert {e[1] for e in packed_entries(7, p, rows, np.zeros(len(rows), bool), 1)} == {0}
    many = 5 * CHUNK // 16
    members = spark.createDataFrame([(3, i % 256, i // 256, 9, 16) for i in range(many)] + [(3, 0, 1, -1, 99), (4, 1, 1, 9, 5)],
                                    "range int, salt int, uid long, key long, n long")
    got = dealt(members).collect()
    assert len(got) == many + 2
    cells = [set(x.cells) for x in got if x.range == 3 and x.key == 9]
    assert all(a & b for a in cells for b in set(map(frozenset, cells)))
    load = {}
    for x in got:
        for c in x.cells:
            load[x.range, x.key, c] = load.get((x.range, x.key, c), 0) + x.n
    assert load[3, -1, 0] == 99 and load[4, 9, 0] == 5 and max(load.values()) < 2.4 * CHUNK


def test_hashes_of_words_are_equal_as_the_words_are():
    texts = [b"", b"Some\twords  of some\x0bWORDS", b"", b"of", "schöne wörter schöne".encode(), b" \n ", b"aa a aaa\x00 aaa", b"z" * 600_000 + b" z",
             b"Z" * 600_000, b"q " * 300_000, b"some"]
    hashes, sizes = word_hashes(b"".join(texts), np.cumsum(list(map(len, texts))))
    words = [w for t in texts for w in t.lower().split()]
    assert sizes.tolist() == [len(t.split()) for t in texts] and len(hashes) == len(words)
    of = {}
    for w, h in zip(words, hashes.tolist()):
        assert of.setdefault(w, h) == h
    assert len(set(of.values())) == len(of)
    assert [len(x) for x in word_hashes(b"", np.zeros(0, np.int64))] == [0, 0]
    assert word_hashes(b"", np.zeros(2, np.int64))[1].tolist() == [0, 0]


def test_a_pair_that_fails_keeps_no_other_from_being_tried():
    """Of the candidates of two classes only the last holds."""
    n = 200
    tried = []

    def verify(a, b):
        tried.extend(zip(a.tolist(), b.tolist()))
        return (a == 3) & (b == n - 1)

    label = np.arange(n)
    a = np.repeat(np.arange(n // 2), n // 2)
    b = np.tile(np.arange(n // 2, n), n // 2)
    kept = spanning(label, a, b, np.full(len(a), AGREE), verify)
    assert [(x, y) for k in kept for x, y in zip(k[0].tolist(), k[1].tolist())] == [(3, n - 1)]
    assert len(tried) == len(set(tried)) == len(a) and label[n - 1] == 3


@pytest.mark.parametrize("variants", [14, 41])
def test_each_named_partner_is_a_verified_one(spark, variants):
    """Variants of a passage, one in three texts unlike the rest: classes and named passages by brute force."""
    r = random.Random(variants)
    base, texts = prose(600, 70).split(), {}
    for d in range(variants):
        w = list(base)
        for p in r.sample(range(70), 2 if d % 3 else 12):
            w[p] = f"v{d}x{p}"
        texts[d] = " ".join([prose(700 + d, 20), *w])
    got = {x.doc_id: x for x in passage_classes(documents(spark, list(texts.items())).repartition(3)).collect()}
    u = Union()
    for d in texts:
        for e in range(d):
            if brute_similarity(texts[d], texts[e]) >= 0.8:
                u.join(d, e)

    def window(d, at):
        w = texts[d].lower().split()[at: at + 50]
        return {tuple(w[i: i + 5]) for i in range(46)}

    for d, x in got.items():
        a, b = window(d, x.start_word), window(x.partner_id, x.partner_start)
        assert x.partner_id != d and u.find(x.partner_id) == u.find(d)
        assert x.similarity >= 0.8 and abs(len(a & b) / len(a | b) - x.similarity) < 1e-12
    found = {d for d in texts if sum(u.find(e) == u.find(d) for e in texts) > 1}
    assert set(got) <= found and len(got) >= 0.9 * len(found)
