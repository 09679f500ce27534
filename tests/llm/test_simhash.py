import numpy as np
import pytest

from acctlens.llm.graph import components
from acctlens.llm.simhash import drop_near_copies, forest, route, simhash_groups, vantage_tree
from tests.llm.helpers import Union, brute_components, documents, edge_rows, prose


def test_equals_brute_force_on_edge_cases(spark):
    rows = edge_rows() + [(100 + i, prose(50, 200)[: 900 + 7 * i]) for i in range(12)]
    got = [tuple(r) for r in simhash_groups(documents(spark, rows, clash=True)).collect()]
    assert sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1])) == brute_components(rows)


def test_empty_table(spark):
    assert simhash_groups(documents(spark, [])).collect() == []
    assert drop_near_copies(documents(spark, [])).collect() == []


def test_one_document_of_each_group_stays(spark):
    rows = edge_rows()
    want = {c for d, _, c in brute_components(rows) if d is not None}
    left = [r.doc_id for r in drop_near_copies(documents(spark, rows)).collect()]
    assert sorted(x for x in left if x is not None) == sorted(want)
    assert left.count(None) == 1


@pytest.mark.parametrize("depth", [0, 1, 4, 6])
def test_tree_finds_every_link(depth):
    rng = np.random.default_rng(depth)
    centres = rng.integers(-(1 << 63), 1 << 63, 60)
    fps = [c for c in centres]
    for c in centres:  # clouds: chains of small steps
        for _ in range(8):
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                c = c ^ (np.int64(1) << np.int64(b))
            fps.append(c)
    fps = np.unique(np.array(fps, np.int64))
    heap = vantage_tree(fps, depth) if depth else [None]
    leaves = {}
    for leaf, entries, home in route(fps, heap, 3):
        leaves.setdefault(leaf, [[], []])[0 if home else 1].append(entries)
    u = Union()
    lived = 0
    for own, guests in leaves.values():
        own = np.concatenate(own) if own else fps[:0]
        lived += len(own)
        a, b = forest(own, np.concatenate([own, *guests]), 3)
        for x, y in zip(a.tolist(), b.tolist()):
            u.join(x, y)
    assert lived == len(fps)  # each entry lives in one leaf
    want = Union()
    for i, x in enumerate(fps):
        for y in fps[:i][np.bitwise_count((fps[:i] ^ x).view(np.uint64)) <= 3]:
            want.join(int(x), int(y))
    assert all(u.find(int(x)) == want.find(int(x)) for x in fps)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    df = spark.createDataFrame([*path, *star, (7, 7)], "u long, v long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}}


def test_a_doc_id_with_unlike_texts_takes_no_group_along(spark):
    a, b, c = prose(61, 200), prose(62, 200), prose(63, 200)
    rows = [(1, a), (2, a), (2, b), (3, b), (4, c), (4, prose(64, 200)), (4, c), (5, c)]
    left = sorted((r.doc_id, r.text) for r in drop_near_copies(documents(spark, rows, clash=True)).collect())
    assert left == sorted([(1, a), (2, b), (4, c), (4, prose(64, 200))])
