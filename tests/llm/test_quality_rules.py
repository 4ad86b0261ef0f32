import random
import re
from collections import Counter

from stemma.llm import quality_rules as R


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(t.count(x) for x in R.SYMBOLS), dup, len(covered), failed


def test_counts(spark, docs, odd_texts):
    random.seed(9)
    rows = odd_texts + [(100 + i, "".join(random.choice(["a ", "b ", "the ", "c\n", "\n", "# ", "| ", "é\x0b", "😀 "]) for _ in range(random.randint(0, 200)))) for i in range(150)]
    rows += [(400, "x y z " * 3000), (401, "a b c\n" * 40 + "the end of it"), (402, "the " * 60)]
    got = R.verdicts(docs(rows).repartition(3)).collect()
    assert Counter(tuple(r)[:7] for r in got) == Counter((i, *brute(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in got)
    assert R.verdicts(docs([])).collect() == []


def test_thresholds(spark, docs):
    clean = " ".join(f"the{chr(97 + i % 26)}{i} and" for i in range(60))
    noisy = " ".join(f"word{i}&&& the" for i in range(60))
    shout = " ".join(f"WORD{i}!! the" for i in range(60)).replace(" the", " W!!")
    got = {r.doc_id: r.kept for r in R.verdicts(docs([(1, clean), (2, noisy), (3, shout)])).collect()}
    assert got == {1: True, 2: False, 3: False}
    loose = [("n_words", 1, None)]
    assert all(r.kept for r in R.verdicts(docs([(1, clean), (2, noisy)]), loose).collect())


def test_no_user_functions(spark, docs):
    plan = R.verdicts(docs([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
