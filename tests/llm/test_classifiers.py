import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stemma.llm import ftrl
from stemma.llm import quality_classifier as Q
from stemma.llm import toxicity as T

WORDS = "tree river stone house light green walk under bridge garden winter summer table candle mirror letter music yellow silver forest".split()


@pytest.fixture(scope="module")
def corpus():
    random.seed(8)
    rows, labels = [], []
    for i in range(400):
        w = [random.choice(WORDS) for _ in range(random.randint(20, 60))]
        good, toxic = i % 4 > 0, i % 5 == 0
        if toxic:
            for _ in range(3):
                w.insert(random.randrange(len(w)), random.choice(["idiot", "zorgwei", "zorglat", "pathetic"]))
        text = " ".join(w) if good else " ".join(x.upper() + "!!" for x in w)
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


def table(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("score", F.lit("x"))


def test_ftrl_learns_and_is_the_same_each_time():
    r = np.random.default_rng(1)
    rows = []
    for _ in range(300):
        i = np.unique(r.integers(1, 50, 8)).astype(np.int32)
        rows.append((np.append(i, 0).astype(np.int32), np.ones(len(i) + 1, np.float32)))
    y = np.array([float(7 in i) for i, _ in rows])
    w = ftrl.fit(rows, y, np.ones(300), 64, epochs=10)
    p = np.array([ftrl.sigmoid(w[i] @ x) for i, x in rows])
    assert ((p > 0.5) == y).mean() > 0.98 and (w == ftrl.fit(rows, y, np.ones(300), 64, epochs=10)).all()
    assert not ftrl.fit([], np.zeros(0), np.zeros(0), 8).any()
    assert (ftrl.fit(rows, y, np.ones(300), 64, free=[0])[1:] >= 0).all()


def test_quality(spark, docs, corpus):
    rows, labels = corpus
    got = Q.score_table(docs(rows).repartition(3), table(spark, labels)).collect()
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    again = {r.doc_id: r.score for r in Q.score_table(docs(rows).repartition(7), table(spark, labels)).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_sparse_dot_product(corpus):
    w = np.random.default_rng(2).standard_normal(Q.DIMS).astype(np.float32)
    for text in ["", None, "a b a b c", "x" * 5000, corpus[0][0][1], "word " * 20000]:
        i, x = Q.example(text)
        assert abs(Q.score_texts([text], w)[0] - ftrl.sigmoid(np.dot(w[i].astype(float), x))) < 1e-4


def test_toxicity(spark, docs, corpus):
    rows, labels = corpus
    got = T.score_table(docs(rows).repartition(3), table(spark, labels)).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def slow_label_model(votes, steps):
    """The label model with loops over rows and voters; None abstains."""
    n, m = len(votes), len(votes[0])
    most = max(1.0, max(sum(x or 0 for x in r[:-1]) for r in votes))
    post = [0.05 + 0.9 * (r[-1] if r[-1] is not None else sum(x or 0 for x in r[:-1]) / most) for r in votes]
    for _ in range(steps):
        rate = {}
        for c in (0, 1):
            for j in range(m):
                w = [(p if c else 1 - p, r[j]) for p, r in zip(post, votes) if r[j] is not None]
                extra = T.TRUST if j == m - 1 else 0.0
                rate[c, j] = (sum(x * v for x, v in w) + extra * T.RATES[c] + 0.5) / (sum(x for x, _ in w) + extra + 1)
        off = [[None if r[j] is None else r[j] - (p * rate[1, j] + (1 - p) * rate[0, j]) for j in range(m)] for p, r in zip(post, votes)]

        def cov(a, b):
            pairs = [(x[a], x[b]) for x in off if x[a] is not None and x[b] is not None]
            return sum(x * y for x, y in pairs) / max(1, len(pairs))

        spread = [max(cov(j, j), 1e-9) ** 0.5 for j in range(m)]
        share = [1 / max(1, sum(max(0, cov(j, k) / (spread[j] * spread[k])) for k in range(m))) for j in range(m)]
        share[-1] = 1
        new = []
        for r in votes:
            z = np.log(sum(post) / sum(1 - p for p in post))
            for j, x in enumerate(r):
                if x is not None:
                    z += share[j] * np.log((rate[1, j] if x else 1 - rate[1, j]) / (rate[0, j] if x else 1 - rate[0, j]))
            new.append(min(max(1 / (1 + np.exp(-z)), 1e-4), 1 - 1e-4))
        moved = max(abs(a - b) for a, b in zip(new, post))
        post = new
        if moved < 1e-4:
            break
    return np.array(post)


def test_label_model_against_loops():
    r = np.random.default_rng(9)
    y = r.random(60) < 0.3
    votes = [[int(r.random() < (a if t else b)) for a, b in ((0.9, 0.05), (0.8, 0.1), (0.8, 0.1), (0.3, 0.3))] + [int(t) if r.random() < 0.5 else None] for t in y]
    votes[0][0] = votes[1][2] = None  # any voter may abstain
    table = np.array([[np.nan if x is None else x for x in v] for v in votes], float)
    for steps in (1, 3, 30):
        assert np.allclose(T.label_model(table, steps), slow_label_model(votes, steps), rtol=0, atol=1e-9)


def test_label_model_finds_the_accurate_voters():
    r = np.random.default_rng(3)
    y = (r.random(2000) < 0.2).astype(float)
    vote = lambda a: np.where(r.random(2000) < a, y, 1 - y)
    same = vote(0.7)
    v = np.stack([vote(0.95), vote(0.9), same, same, same, vote(0.85)], 1)  # three voters that are one
    assert ((T.label_model(v) > 0.5) == y).mean() > 0.95


def test_label_model_without_annotators_is_near_bayes():
    r = np.random.default_rng(5)
    y = r.random(20000) < 0.15
    rates = [(0.7, 0.01), (0.5, 0.02), (0.6, 0.03), (0.4, 0.01), (0.5, 0.05)]
    v = np.stack([r.random(20000) < np.where(y, a, b) for a, b in rates], 1).astype(float)
    z = np.log(0.15 / 0.85) + sum(np.where(v[:, j] > 0, np.log(a / b), np.log((1 - a) / (1 - b))) for j, (a, b) in enumerate(rates))
    got = T.label_model(np.column_stack([v, np.full(20000, np.nan)]), 200)
    assert np.abs(got - 1 / (1 + np.exp(-z))).mean() < 0.02 and ((got > 0.5) == y).mean() > 0.97


def test_toxicity_learns_from_unlabelled_documents(spark, docs, corpus):
    """Without a single label the lexicons' rates are estimated all the same, and the classifier learns their words."""
    rows, labels = corpus
    truth = {i: t for i, _, t in labels}
    got = T.score_table(docs(rows).repartition(3), table(spark, [])).collect()
    assert np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.8
    few = T.score_table(docs(rows).repartition(3), table(spark, labels[:100])).collect()
    assert np.mean([r.predicted == truth[r.doc_id] for r in few if r.held_out]) > 0.9


def slow_ftrl(rows, targets, weights, dims, alpha, beta, l1, l2, epochs, seed):
    """Follow-the-regularised-leader with a loop over every feature."""
    z, n, order = [0.0] * dims, [0.0] * dims, np.random.default_rng(seed)

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            w = {int(i): weight(i) for i in rows[k][0]}
            p = 1 / (1 + np.exp(-sum(w[int(i)] * x for i, x in zip(*rows[k]))))
            for i, x in zip(*rows[k]):
                g = (p - targets[k]) * weights[k] * x
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w[int(i)]
                n[i] += g * g
    return np.array([weight(i) for i in range(dims)])


def test_ftrl_against_loops():
    r = np.random.default_rng(4)
    rows = [(np.unique(r.integers(0, 40, 10)).astype(np.int32),) for _ in range(80)]
    rows = [(i, r.random(len(i))) for (i,) in rows]
    y, share = r.random(80), r.random(80) + 0.5
    for l1 in (1e-3, 0.5):
        a = ftrl.fit(rows, y, share, 40, alpha=0.5, l1=l1, epochs=3, seed=7)
        assert np.allclose(a, slow_ftrl(rows, y, share, 40, 0.5, 1.0, l1, 1e-4, 3, 7), rtol=0, atol=1e-5)


def test_shape_reads_whole_words():
    assert Q.shape("a" * 70 + "1" * 5) == "a0" and Q.shape("Ab-9") == "Aa-0" and Q.shape("") == ""


def test_bytes_bound_the_sample(spark, docs, corpus, monkeypatch):
    rows, labels = corpus
    all_ = Q.learn(docs(rows), table(spark, labels), "quality", 3, 1, 50, Q.example)
    size = {r[0]: r[2].nbytes + r[3].nbytes for r in all_}
    monkeypatch.setattr(Q, "TRAIN_BYTES", sum(size.values()) // 2)
    some = Q.learn(docs(rows), table(spark, labels), "quality", 3, 1, 50, Q.example)
    assert 0 < len(some) < len(all_) and sum(size[r[0]] for r in some) <= Q.TRAIN_BYTES and {r[0] for r in some} <= set(size)
    monkeypatch.undo()
    more = T.learn(docs(rows), table(spark, labels[:40]), "toxic", 4, 2, 20, T.example, 100)
    assert len([r for r in more if r[1] is None]) > 30 and len({r[0] for r in more}) == len(more)
    assert all(zlib.crc32(str(r[0]).encode()) % 4 != 2 for r in more)


@pytest.mark.parametrize("module", [Q, T])
def test_odd_tables(spark, docs, odd_texts, corpus, module):
    rows, labels = corpus
    extra = [(1000 + (i or 0) if i is not None else None, t) for i, t in odd_texts]
    dirty = [*labels, (None, 1, 1), (0, None, None), (0, 1, 1), (99999, 1, 0)]
    got = module.score_table(docs(rows + extra), table(spark, dirty)).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in got)
    none = module.score_table(docs(extra), table(spark, [])).collect()
    assert len(none) == len(extra) and all(0 <= r.score <= 1 for r in none)
    one_class = module.score_table(docs(rows), table(spark, [(i, 1, 1) for i, _, _ in labels])).collect()
    assert len(one_class) == len(rows)
    assert module.score_table(docs([]), table(spark, labels)).collect() == []


def test_labels_of_the_held_out_fold_change_nothing(spark, docs, corpus):
    rows, labels = corpus
    for module, parts, out in ((Q, 3, 1), (T, 4, 2)):
        other = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % parts == out else (i, q, t) for i, q, t in labels]
        a, b = ({r.doc_id: r.score for r in module.score_table(docs(rows), table(spark, x)).collect()} for x in (labels, other))
        assert a == b


def test_a_recurring_document_leaves_the_others_in_the_fit(spark, docs, corpus):
    rows, labels = corpus
    once = Q.learn(docs(rows), table(spark, labels), "quality", 3, 1, 20, Q.example)
    assert len(once) == 20
    hot, text = once[0][0], dict(rows)[once[0][0]]
    more = rows + [(hot, text)] * 300 + [(hot, "~ another text")] * 300
    a, b = (Q.learn(docs(x).repartition(n), table(spark, labels), "quality", 3, 1, 20, Q.example) for x, n in ((more, 3), (more[::-1], 5)))
    assert [r[0] for r in a] == [r[0] for r in b] == [r[0] for r in once]
    assert all(np.array_equal(x[2], y[2]) and np.array_equal(x[3], y[3]) for x, y in zip(a, b))
    assert all(np.array_equal(x[2], y[2]) for x, y in zip(a[1:], once[1:]))
