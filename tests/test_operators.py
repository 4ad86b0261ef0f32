import json
import random
import re
from difflib import SequenceMatcher
from math import log

import pytest
from pyspark.sql import functions as F

from stemma.functions import fixed_values as V
from stemma.operators import audit, dedupe, extract, joins, matching, sampling, segment


def test_dedupe(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), ("b", 1, "z"), (None, 3, "n")], "k string, o int, v string")
    got = {r.k: r.v for r in dedupe.best_by(df, ["k"], [F.asc("o"), F.asc("v")]).collect()}
    assert got == {"a": "y", "b": "z", None: "n"}
    assert {r.k: r.v for r in dedupe.last_wins(df, "k", [F.col("o"), F.col("v")]).collect()} == {"a": "x", "b": "z"}


def test_overlay_and_zero(spark):
    base, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, joins.overlay(base, new, "k").collect())) == [(1, "a"), (2, "c"), (3, "d")]
    keys = spark.createDataFrame([("title",), ("title0",), ("title00",), ("other0",)], "key string")
    assert sorted(map(tuple, joins.trailing_zero(keys, "key").collect())) == [("other0", False), ("title", False), ("title", True), ("title0", True)]
    got = joins.insert_absent(base, spark.createDataFrame([(2, "z"), (4, "q"), (4, "p")], "k int, v string"), ["k"], [F.asc("v")])
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "b"), (4, "p")]


def test_rejections(spark):
    rows = spark.createDataFrame([(1, "t", "Title", "title", "wikimedia"), (2, "t", "Else", "else", "wikimedia"), (3, "u", "Title", "title", "")], "i int, normalized_title string, a string, b string, s string")
    rej = spark.createDataFrame([("t", "TITLE", "wiki", "why", 1), ("t", "title", "", "", 2), ("t", "title", "other", "no", 3)], "normalized_title string, rejected string, source string, reason string, ordinal int")
    got = {r.i: r.rejection_notes for r in joins.rejection_reasons(rows, rej, "i", F.col("a"), F.col("b"), F.col("s")).collect()}
    assert got == {1: "why; manual rejection", 2: "", 3: ""}


def test_gap_and_top(spark):
    df = spark.createDataFrame([("a", 100, 1), ("a", 90, 2), ("b", 100, 1), ("b", 97, 2), ("c", 99, 1), ("d", 80, 1), ("d", 70, 2)], "k string, s int, o int")
    got = {r.k: r.status for r in matching.gap_status(df, ["k"], "s", [F.desc("s"), F.asc("o")]).collect()}
    assert got == {"a": "matched", "b": "ambiguous", "c": "matched", "d": "unmatched"}


def test_ratio_and_scores(spark):
    random.seed(1)
    pairs = [("".join(random.choice("abc ") for _ in range(random.randint(0, 12))), "".join(random.choice("abc ") for _ in range(random.randint(0, 12)))) for _ in range(50)] + [("baldurs gate", "baldur s gate")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", matching.ratio(F.col("a"), F.col("b")).alias("r"), matching.length_bound(F.col("a"), F.col("b")).alias("m")).collect():
        assert r.r == SequenceMatcher(None, r.a, r.b).ratio() and r.r <= r.m + 1e-12
    k = spark.createDataFrame([(1, "Arena Wars v 1", "Arena Wars"), (2, "Anno", "Anno"), (3, "Anno", "Anno 1602"), (4, "baldurs gate two", "baldurs gote two"), (5, "x", "y")], "k int, v string, t string")
    assert {r.k: r.score for r in matching.candidate_scores(k, ["k"], "v", "t").collect()} == {1: 96, 2: 100, 3: 82, 4: 80, 5: 0}


def brute_segment(token, vocab):
    if len(token) < 6 or vocab.get(token, 0) >= 3:
        return None
    best = {len(token): (0.0, ())}
    for i in range(len(token) - 2, -1, -1):
        for e in range(i + 2, min(len(token), i + 20) + 1):
            n = vocab.get(token[i:e], 0)
            if n and e in best:
                s = round(log(n + 1.0) - 0.25 + best[e][0], 9)
                if i not in best or s > best[i][0]:
                    best[i] = (s, (token[i:e], *best[e][1]))
    s, p = best.get(0, (0, ()))
    ok = len(p) >= 2 and s >= 3.5 and all(vocab[x] >= 2 or x in V.SMALL_WORDS for x in p)
    return " ".join(p) if ok else None


def test_segmentation(spark):
    random.seed(2)
    titles = ["Needfor Speed", "Age of Empires", "Rageof War", "speed war age", "zumspiel", "of the war", "empires empires", "chaosistdas"]
    parts = ["of", "the", "war", "age", "speed", "xy", "zu", "um", "empires", "rage"]
    tokens = sorted({"".join(random.choice(parts) for _ in range(random.randint(1, 5))) for _ in range(200)})
    vocab = segment.vocabulary(segment.words(spark.createDataFrame([(t,) for t in titles], "t string"), "t"))
    counts = {r.word: r.n for r in vocab.collect()}
    assert counts["of"] == 200 + 2 and counts["empires"] == 25 + 3
    got = {r.token: " ".join(r.parts) for r in segment.segmentations(spark.createDataFrame([(t,) for t in tokens], "token string"), vocab).collect()}
    assert got == {t: s for t in tokens if (s := brute_segment(t, counts))}
    long = "warage" * 3334
    got = segment.segmentations(spark.createDataFrame([(long,)], "token string"), vocab).collect()
    assert got and "".join(got[0].parts) == long and got[0].parts[:4] == ["war", "age", "war", "age"]


def test_segmentation_keeps_rows_small_and_broadcasts_nothing(spark):
    """Long tokens, alike but for their ends, are parted whole; no side of a join is collected, no row repeats a token."""
    vocab = segment.vocabulary(segment.words(spark.createDataFrame([("war age war age speed speed",)], "t string"), "t"))
    tokens = ["warage" * 10_000 + end for end in ("", "war", "speed")] + ["waragespeed", "w" * 63 + "war"]
    df = segment.segmentations(spark.createDataFrame([(t,) for t in tokens], "token string"), vocab)
    got = {r.token: r.parts for r in df.collect()}
    assert got == {t: re.findall("war|age|speed", t) for t in tokens[:4]}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_words_are_those_of_the_parted_title(spark):
    """words() counts runs of letters first; split_camel and normalize_spaces on whole titles give the same words."""
    from stemma.functions.text import normalize_spaces, split_camel

    random.seed(5)
    titles = ["".join(random.choice(["Need", "for", "SPEED", "Xy", "é", "Ü", "2", "12", "'", "’", "-", "–", " ", " ,", "a", "B", "\u00a0", "ß", "×"]) for _ in range(random.randint(0, 12))) for _ in range(800)] + [None]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    slow = df.select(F.explode(F.regexp_extract_all(split_camel(normalize_spaces(F.col("t"))), F.lit(f"[{segment.LETTERS}]+"), F.lit(0))).alias("w"))
    from stemma.functions.fold import folded
    from collections import Counter

    want = Counter(folded(r.w).lower() for r in slow.collect())
    assert {r.word: r.n for r in segment.words(df, "t").collect()} == dict(want)


def test_compounds_of_repeated_titles(spark):
    vocab = segment.vocabulary(segment.words(spark.createDataFrame([("Lord of War",)] * 4, "t string"), "t"))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["Lordofwar 2", "Lordofwar 2", "plain", "", " two  blanks "])], "i int, t string")
    got = sorted((r.i, r.t, r.split_any) for r in segment.repair_compounds(df, "t", vocab).collect())
    assert got == [(0, "Lord of War 2", True), (1, "Lord of War 2", True), (2, "plain", False), (3, "", False), (4, "two blanks", False)]


def test_hints_and_words_are_looked_at_once(spark):
    """A word is folded once, not for each hint; the hints stay the same, and so do the parted titles."""
    df = spark.createDataFrame([(w,) for h in V.SEGMENT_HINTS for w in (h, f"x{h}", f"{h}x", f"x{h}x", f"xx{h}\ny", f"é{h}é")] + [("",), ("x",), (None,)], "w string")
    plan = df.where(segment.hinted(F.lower(segment.ascii_fold(F.col("w")))))
    got = {r.w for r in plan.collect()}
    assert got == {r.w for r in df.collect() if r.w and any(h in r.w[1:-1] for h in V.SEGMENT_HINTS)}
    assert "exists(" not in plan._jdf.queryExecution().executedPlan().toString()
    vocab = segment.vocabulary(segment.words(spark.createDataFrame([("Lord of War",)] * 4, "t string"), "t"))
    titles = spark.createDataFrame([(f"Lordofwar {i}",) for i in range(50)], "t string")
    out = segment.repair_compounds(titles, "t", vocab)
    assert {r.t for r in out.collect()} == {f"Lord of War {i}" for i in range(50)}


def test_trailing_zero_deals_rows_by_key(spark):
    """Rows without a zero have no common join key."""
    df = spark.createDataFrame([("a",), ("a0",), ("b0",), ("c",), ("0",), ("",), (None,)], "k string")
    out = joins.trailing_zero(df, "k")
    assert sorted((r.k or "", r.merged) for r in out.collect()) == [("", False), ("", False), ("", True), ("a", False), ("a", True), ("b0", False), ("c", False)]
    assert "ELSE k#" in out._jdf.queryExecution().optimizedPlan().toString()


def test_sections(spark):
    def titles(text, kind="archiveorg-ocr"):
        df = spark.createDataFrame([(1, kind, "p", "high", text)], "i int, source_kind string, source_path string, confidence string, text string")
        rows = extract.text_candidates(df, ["i"], "text").collect()
        return {r.normalized_title for r in rows}

    assert titles("Vollversion:\n- Anno 1602\nDemos:\n- Prince of Persia 3D\n- RollerCoaster Tycoon") == {"anno1602", "prince of persia 3d", "roller coaster tycoon"}
    assert titles("CD-Inhalt\nVollversion:\n* Anno 1602\nDemos:\n* Prince of Persia 3D\n") == {"anno1602", "prince of persia 3d"}
    assert titles(f"{V.GENERIC_TITLES[1]}\nGold\nCD-Inhalt") == set()
    assert titles("Anno 1602 Gold\nsecond line", "archiveorg-title") == {"anno1602"}
    assert titles("a long line that is no title", "archiveorg-ocr") == set()


def test_metadata_and_paths(spark):
    f = spark.createDataFrame([("a", "autorun.inf", "[x]\nlabel=Prince of Persia 3D Demo\nopen=Games/Anno1602/setup.exe\nbad"), ("a", "e.inf", "")], "archive string, path string, text string")
    got = {(r.normalized_title, r.source_kind) for r in extract.metadata_candidates(f, ["archive"]).collect()}
    assert ("prince of persia 3d", "disc-metadata-value") in got
    e = spark.createDataFrame([("a", "CBS/Demo/progs/Anno1602/DEMO/ANNO1602DEMO.exe")], "archive string, path string")
    assert [(r.candidate_title, r.normalized_title, r.source_kind) for r in extract.exe_candidates(e, ["archive"]).collect()] == [("Anno1602", "anno1602", "disc-exe-parent")]


def test_payload(spark):
    p = json.dumps({"metadata": {"subject": ["Anno 1602", V.GENERIC_TITLES[1], "Prince of Persia 3D"], "title": "Icewind Dale"}})
    df = spark.createDataFrame([("i", "id1", p)], "issue string, identifier string, payload string")
    got = extract.payload_candidates(df, ["issue"]).collect()
    assert {(r.normalized_title, r.source_kind) for r in got} == {("anno1602", "archiveorg-subject"), ("prince of persia 3d", "archiveorg-subject"), ("icewind dale", "archiveorg-title")}
    assert all(r.structured for r in got if r.source_kind == "archiveorg-subject")


def test_discs(spark):
    cue = 'FILE "disc.bin" BINARY\n TRACK 01 AUDIO\n  INDEX 01 00:00:00\n TRACK 02 MODE1/2352\n  INDEX 00 00:01:00\n  INDEX 01 00:02:10\n TRACK 03 AUDIO\n  INDEX 01 01:00:00'
    s = spark.createDataFrame([("a", cue)], "archive string, text string")
    r = extract.cue_tracks(s, ["archive"]).first()
    assert (r.file, r.track, r.mode, r.start, r.end) == ("disc.bin", "02", "MODE1/2352", 160, 4500)
    m = spark.createDataFrame([("a", "d/disc.cue", 'FILE "disc.bin" BINARY'), ("a", "d/disc.bin", None), ("a", "d/bonus.iso", None)], "archive string, path string, text string")
    assert sorted(r.path for r in extract.containers(m, ["archive"]).collect()) == ["d/bonus.iso", "d/disc.cue"]
    raw = b"".join(b"\x00" * 16 + c * 2048 + b"\xff" * 288 for c in (b"A", b"B"))
    df = spark.createDataFrame([(bytearray(raw),)], "c binary")
    assert bytes(df.select(extract.sector_payload(F.col("c"), F.lit(0), F.lit(2))).first()[0]) == b"A" * 2048 + b"B" * 2048


def test_listing_and_links(spark):
    js = '{"files": [{"name": "2000/CBS092000.7z", "size": "12"}, {"name": "2000/Scans/x.7z"}, {"name": "bad.7z"}, {"name": "2000/odd.7z"}]}'
    got = extract.archive_records(spark.createDataFrame([("item", js)], "archive_item string, listing string")).collect()
    assert [(r.archive_name, r.size_bytes, r.year, r.variant) for r in got] == [("2000/CBS092000.7z", 12, 2000, "CD")]
    m = spark.createDataFrame([({"dewiki": "D", "enwiki": "E"},), ({"frwiki": "F", "commonswiki": "C"},), ({},)], "m map<string,string>")
    got = [r[0] for r in m.select(extract.preferred_link(F.col("m"))).collect()]
    assert [(x.site, x.title) if x else None for x in got] == [("enwiki", "E"), ("frwiki", "F"), None]


def test_audit(spark):
    f = spark.createDataFrame([("A", "anno1602"), ("B", "anno1602"), ("B", "prince of persia 3d")], "strategy string, title string")
    got = {r.strategy: (r.union_size, r.recall) for r in audit.recall(f, {"all": ["A", "B"]}).collect()}
    assert got == {"A": (2, 0.5), "B": (2, 1.0), "all": (2, 1.0)}
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "a int, b string")
    moved = [spark.createDataFrame([x], "a string, b string, c array<string>") for x in ((None, "x", ["p", None]), ("x", None, ["p", None]), (None, "x", [None, "p"]))]
    assert len({audit.digest(m).first().digest for m in moved}) == 3
    assert audit.digest(a).first() == audit.digest(a.orderBy(F.desc("a")).select("b", "a")).first() != audit.digest(a.distinct()).first()
    n = audit.near_variants(spark.createDataFrame([("Für Elise",), ("Fuer elise!",), ("x",)], "t string"), "t").collect()
    assert [r.members for r in n] == [["Fuer elise!", "Für Elise"]]


@pytest.mark.parametrize("size", [3, 10, 100])
def test_sample(spark, size):
    df = spark.range(60).select(F.col("id").alias("k"), (F.col("id") % 4).alias("s"))
    a, b = (sorted(r.k for r in sampling.stratified(df.repartition(n), ["s"], "k", size).collect()) for n in (1, 5))
    assert a == b and len(a) == min(size, 60)
    if size >= 4:
        assert {k % 4 for k in a} == {0, 1, 2, 3}


def test_images_and_pages(spark):
    m = spark.createDataFrame([("a", "d/x.mds", 5), ("a", "d/x.mdf", 7), ("a", "d/y.ccd", 1), ("a", "d/z.cue", 1), ("a", "d/w.iso", 2)], "archive string, path string, length bigint")
    got = {r.path: (r.image_path, r.how) for r in extract.image_paths(m.where("path not like '%mdf'").select("archive", "path"), m, ["archive"]).collect()}
    assert got == {"d/x.mds": ("d/x.mdf", "data file"), "d/y.ccd": ("d/y.ccd", "as it is"), "d/z.cue": ("d/z.iso", "sheet to image"), "d/w.iso": ("d/w.iso", "as it is")}
    assert extract.activity(m).first() == (5, 16)
    y = spark.createDataFrame([("CBS092000", 2000), ("CBS0111", 2011)], "c string, y int")
    assert [r[0] for r in y.select(extract.issue_page(F.col("c"), F.col("y"), "http://x/")).collect()] == ["http://x/09-2000.html", None]
