import numpy as np
import pytest

from acctlens.llm.linear import Logistic
from acctlens.llm.quality import CoTrained, keep_good, quality_scores
from acctlens.llm.toxicity import Restorer, character_counts, learn_evidence, symbol, toxicity_scores
from tests.llm.helpers import documents, edge_rows, prose

LABELS = "doc_id long, quality int, toxic int, score string, y string"


def labels(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows], LABELS)


@pytest.fixture(scope="module")
def corpus(spark):
    """Prose, junk, and texts with bad words."""
    rows, marks = [], []
    for i in range(400):
        junk, bad = i % 5 == 1, i % 7 == 3
        text = prose(i, 80).replace("w", "mora")
        text = "".join(c if not c.isdigit() else "aeioutnrsl"[int(c)] for c in text)
        if junk:
            text = " | ".join(text.split()) if i % 2 else text.upper().replace(" ", "!! ")
        if bad:
            words = text.split(" ")
            text = " ".join([*words[:20], "idiot", *words[20:40], "moron", *words[40:], "you", "scum"])
        rows.append((i, text))
        marks.append((i, int(not junk), int(bad)))
    planted = [(9000, "you are an 1d10t and a m0r0n"), (9001, "such an i d i o t , all m.o.r.o.n s"), (9002, "what a moroooon and idiiiiot"),
               (9003, prose(5, 60).replace("w", "mora"))]
    return documents(spark, rows + planted + edge_rows()), labels(spark, [*marks, (1, None, None), (3, 0, 0), (3, 1, 1), (None, 1, 1)])


def test_quality_on_held_out_rows(spark, corpus):
    docs, marks = corpus
    out = {r.doc_id: r for r in quality_scores(docs, marks).collect()}
    held = [i for i in range(4, 400) if out[i].held_out]
    assert len(held) > 40
    assert sum(out[i].predicted == int(i % 5 != 1) for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values()) and docs.count() == quality_scores(docs, marks).count()


def test_rejected_documents_go(spark, corpus):
    docs, marks = corpus
    kept = keep_good(docs, marks)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    good = [i for i in range(4, 400) if i % 5 != 1]
    assert len(set(ids) & set(good)) >= 0.98 * len(good)
    assert len(set(ids) & set(i for i in range(4, 400) if i % 5 == 1)) <= 4


def test_no_labels_and_empty_tables(spark):
    docs, none = documents(spark, edge_rows(), clash=True), labels(spark, [])
    assert {r.score for r in quality_scores(docs, none).collect()} == {0.5}
    assert keep_good(docs, none).count() == docs.count()
    assert {r.score for r in toxicity_scores(docs, none).collect()} == {0.0}
    empty = documents(spark, [])
    for f in (quality_scores, toxicity_scores, keep_good):
        assert f(empty, none).collect() == []


def test_toxicity_with_disguised_words(spark, corpus):
    docs, marks = corpus
    out = {r.doc_id: r for r in toxicity_scores(docs, marks).collect()}
    held = [i for i in range(4, 400) if out[i].held_out]
    assert sum(out[i].predicted == int(i % 7 == 3) for i in held) >= 0.97 * len(held)
    assert [out[i].predicted for i in (9000, 9001, 9002, 9003)] == [1, 1, 1, 0]
    assert all(out[d].predicted == 0 for d in (5, 6, 7, 8))


def test_restorer(spark):
    df = documents(spark, [(i, "the idiot is a moron and the clown is here again today " * 3) for i in range(20)])
    r = Restorer(character_counts(df))
    assert r.words("1d10t!!") == ["idiot"] and r.words("cl0wn,") == ["clown"] and r.words("plain") == ["plain"]
    assert r.words("m0roooon") == ["moron"] and r.words("12345") == [] and r.words("") == []
    assert "idiot" in r.set_apart("an i d i o t here") and "moron" in r.set_apart("m-o-r-o-n")
    assert r.restore("a" * 5000)
    assert symbol("é") == 5 and symbol("中") == 0


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 900).astype(float)
    a = (y * 2 - 1)[:, None] * 1.5 + rng.standard_normal((900, 3))
    b = (y * 2 - 1)[:, None] * 1.0 + rng.standard_normal((900, 2))
    back = np.arange(900) < 30
    m = CoTrained().fit(a[:100], b[:100], y[:100], a[100:600], b[100:600], back[:100])
    both = ((m.predict(a[600:], b[600:]) >= 0.5) == y[600:]).mean()
    alone = ((Logistic().fit(b[:100], y[:100]).predict(b[600:]) >= 0.5) == y[600:]).mean()
    assert both > alone and both > 0.95


def test_evidence_counts_rare_words_beside_many_common_ones(spark):
    rng = np.random.default_rng(21)
    common = " ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (7000, 8)))
    rows = [(f"{common} zyxwvut" if i < 8 else common, 1) for i in range(20)] + [(common if i < 40 else "plain", 0) for i in range(180)]
    texts = spark.createDataFrame(rows, "text string, y int").repartition(8)
    found = learn_evidence(texts, Restorer(np.zeros((27, 27, 27))))
    assert "zyxwvut" in found and min(found.values()) > 2
