import re
from collections import Counter

from stemma.llm import license_scan as L

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at = []
    for label, phrase in L.PHRASES:
        p = phrase.split()
        at += [(k, label) for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
    return len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))


def test_places(spark, docs, odd_texts):
    texts = ["Released Under the MIT License. under the mit-license", "Apache License, Version 2.0", "CC BY-NC 4.0 cc by nc cc by nc", "under the MIT", "under the MIT K\u212a License", "UNDER THE MIT LICENSE " * 50]
    rows = odd_texts + [(100 + i, t) for i, t in enumerate(texts)]
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in L.summary(docs(rows).repartition(3)).collect())
    assert got == Counter((i, *brute(t)) for i, t in rows)


def test_altered_notices(spark, docs):
    whole = dict((t, lab) for lab, t in L.NOTICES)
    rows, want = [], {}
    for k, (text, label) in enumerate(whole.items()):
        w = text.split()
        if len(w) < 12:
            continue
        altered = " ".join([*w[:6], "quite", "really", *w[6:]])  # two words put in: the diagonal moves
        rows += [(k, f"some words before {text} and after"), (100 + k, f"before {altered} after"), (200 + k, " ".join(w[: len(w) // 2]))]
        rows.append((300 + k, " ".join([*w[:6], "other", *w[7:]])))
        want |= {k: label, 100 + k: label}
    got = {r.doc_id: r for r in L.summary(docs(rows)).collect()}
    for i, r in got.items():
        assert (want[i] in r.labels.split(",")) if i in want else i >= 300 or r.labels == r.base_labels, (i, r)
        assert 0 <= r.score <= 1 and r.n_base == brute(dict(rows)[i])[1]
    assert got[0].score == got[100].score == 1.0 and got[300].labels == "apache-2" and 0.8 <= got[300].score < 1.0


def test_empty(spark, docs):
    assert L.summary(docs([])).collect() == []


def brute_scan(text):
    """Labels and score by loops: all places of a template's 3-word windows, gathered by diagonal."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    labels, score = set(), 0.0
    for label, phrase, exact in [(*x, True) for x in L.PHRASES] + [(*x, False) for x in L.NOTICES]:
        t = phrase.split()
        by = {}
        for p in range(len(w) - 2):
            for k in range(len(t) - 2):
                if w[p : p + 3] == t[k : k + 3]:
                    by.setdefault(p - k, set()).add(k)
        clusters = []
        for diagonal in sorted(by):
            if clusters and diagonal - clusters[-1][-1] <= L.SLACK:
                clusters[-1].append(diagonal)
            else:
                clusters.append([diagonal])
        for some in clusters:
            at = set().union(*(by[x] for x in some))
            share = min(1.0, len({k + i for k in at for i in range(3)}) / len(t))
            length = max(x + max(by[x]) + 2 for x in some) - min(x + min(by[x]) for x in some) + 1
            whole = any(len(by[x]) == len(t) - 2 for x in some)
            if (exact and whole) or (not exact and share >= L.LEAST and length <= 1.5 * len(t) + L.SLACK):
                labels.add(label)
                score = max(score, 1.0 if exact else share)
    return ",".join(sorted(labels)), score


def test_labels_and_scores_against_loops(spark, docs, odd_texts):
    import random

    r = random.Random(17)
    notices = [t.split() for _, t in [*L.PHRASES, *L.NOTICES]]
    rows = list(odd_texts)
    for k in range(300):
        words = []
        for _ in range(r.randint(0, 4)):
            part = list(r.choice(notices))
            for _ in range(r.randint(0, 6)):  # words taken out, put in, changed, moved
                at = r.randrange(len(part)) if part else 0
                if part and (op := r.randrange(4)) == 0:
                    del part[at]
                elif part and op == 1:
                    part.insert(at, r.choice(["quite", "the", "license", "of"]))
                elif part and op == 2:
                    part[at] = r.choice(["other", "under", "mit"])
                elif part:
                    part = part[at:] + part[:at]
            words += part + [r.choice(["and", "so", "x"]) for _ in range(r.randint(0, 8))]
        rows.append((1000 + k, " ".join(x.upper() if r.random() < 0.1 else x for x in words)))
    got = Counter((x.doc_id, x.labels, round(x.score, 9)) for x in L.summary(docs(rows).repartition(3)).collect())
    assert got == Counter((i, brute_scan(t)[0], round(brute_scan(t)[1], 9)) for i, t in rows)
    assert len({x[1] for x in got}) > 10
