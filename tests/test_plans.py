import pytest
from pyspark.sql import functions as F

from stemma.functions import fixed_values as V
from stemma.plans import enrich, extraction, overlay, publish, resolve
from stemma.plans import schemas as S
from stemma.sources import csvio, snapshots


def frame(spark, columns, rows):
    return spark.createDataFrame([tuple(r.get(c, "") for c in columns) for r in rows], ", ".join(f"{c} string" for c in columns))


def issue(title, code="CBS032008DVD", kinds="disc-metadata-value", norm=None, kind="unknown", conf="high"):
    return {"archive_item": "i", "archive_name": f"{code}.7z", "issue_code": code, "year": code[5:9], "variant": "DVD", "normalized_title": norm or title.lower(), "representative_title": title, "source_kinds": kinds, "confidence": conf, "content_kind": kind}


def published(spark, rows, baseline=(), overrides=(), rejections=()):
    b = frame(spark, ["normalized_title", *V.MATCH_FIELDS], baseline)
    shown, hidden = publish.prepared(frame(spark, S.ISSUE_TITLES, rows), b, frame(spark, S.OVERRIDES, overrides), frame(spark, S.REJECTIONS, rejections))
    from stemma.operators import cluster

    issues = cluster.issue_clusters(shown)
    return publish.masters(issues).collect(), issues.collect(), cluster.excluded(hidden).collect()


def test_clusters(spark):
    rows = [issue("Age of Empires 3 v 1", "CBS022006DVD"), issue("Age of Empires 3 v 1 01a", "CBS022006DVD"), issue("WEBDESmart Surfer", "CBS072008DVD")]
    master, issues, out = published(spark, rows)
    assert [m.game_id for m in master] == ["ageofempires3"] and [i.occurrence_count_in_issue for i in issues] == [2]
    assert [o.content_class for o in out] == ["utility"]
    assert issues[0].observed_title_variants == "Age of Empires 3 v 1; Age of Empires 3 v 1 01a"
    assert master[0].match_status == "unmatched" and master[0].representative_title == "Age of Empires 3"


def test_noise_classes(spark):
    names = ["Disk Defrag", "Easy BCD 171", "Reg Cleaner", "Star Force Vista Update", "Tweak VI", "Vista Boot PRO 3 3", "Chk Schatten", "kreska 1", "plus Schwierigkeitsgrad", "Schwierigkeitsgrad"]
    master, issues, out = published(spark, [issue(n) for n in names])
    assert not master and not issues and len(out) == 10 and {o.content_class for o in out} == {"disc_noise", "utility"}


def test_compounds(spark):
    names = ["Ageof Empires The War Chiefs", "Needfor Speed Carbonv 14", "Galactic Dream Rageof War", "Sherlock Holmesjagt Arsne Lupin", "City Life Updateauf City Life 2008", "Command Conquer3 Tiberium Wars Kanev105"]
    master, issues, out = published(spark, [issue(n) for n in names])
    assert not out and len(issues) == 6
    assert {m.representative_title for m in master} == {"Age of Empires The War Chiefs", "Need for Speed Carbon", "Galactic Dream Rage of War", "Sherlock Holmes jagt Arsène Lupin", "City Life & Update auf City Life 2008", "Command & Conquer 3 Tiberium Wars Kane"}


def test_edition_kept_and_overridden(spark):
    row = issue("Age of Empires Gold Edition", "CBS082004CD", "vollversion-fullversion", kind="full_version")
    master, issues, _ = published(spark, [row])
    assert master[0].game_id == "ageofempiresgoldedition" and issues[0].content_form == "full_version_game"
    master, _, out = published(spark, [row], overrides=[{"game_id": "ageofempiresgoldedition", "content_class": "utility", "publishable": "False", "reason": "r"}])
    assert not master and out[0].content_class == "utility"


def test_publish_end_to_end(spark):
    rows = [issue("Prince of Persia"), issue("Setup", norm="setup"), issue("Baldurs Gate", norm="prim r"), issue("readme file", norm="readme file"), issue("Icewind Dale", norm="icewind dale", kinds="disc-exe-name")]
    t = publish.publish(frame(spark, S.ISSUE_TITLES, rows), frame(spark, ["normalized_title", *V.MATCH_FIELDS], []), frame(spark, S.OVERRIDES, []), frame(spark, S.REJECTIONS, []))
    n = {k: v.count() for k, v in t.items()}
    assert n["final_issue_titles"] + n["dropped_candidates"] == len(rows)
    assert t["publishable_issue_titles"].columns == S.PUBLISHED_ISSUES and t["publishable_master_games"].columns == S.PUBLISHED_MASTER
    assert {r.representative_title for r in t["publishable_master_games"].collect()} >= {"Prince of Persia"}
    assert {r.drop_reason for r in t["dropped_candidates"].collect()} <= {"bad-substring", "bad-exact", "weak-singleword"}


def test_publish_takes_repeated_rows(spark):
    one = issue("Needfor Speed Carbonv 14")
    rows = [one, one, one | {"confidence": "low"}, one | {"content_kind": "demo"}, issue("Prince of Persia"), issue("Ageof Empires The War Chiefs")]
    t = publish.publish(frame(spark, S.ISSUE_TITLES, rows), frame(spark, ["normalized_title", *V.MATCH_FIELDS], []), frame(spark, S.OVERRIDES, []), frame(spark, S.REJECTIONS, []))
    n = {k: v.count() for k, v in t.items()}
    assert n["final_issue_titles"] + n["dropped_candidates"] == len(rows) and n["publishable_issue_titles"] == 3
    got = {r.representative_title: (r.occurrence_count, r.observed_content_kinds) for r in t["publishable_master_games"].collect()}
    assert got["Need for Speed Carbon"] == (4, "demo")


def match(title, norm, year, qid=False):
    out = {"normalized_title": norm, "canonical_title": title, "canonical_slug": title.lower().replace(" ", "-"), "match_status": "matched", "match_confidence": "high", "match_source": "wikimedia", "entity_type": "game", "release_year": year, "genres": "g", "wikidata_id": "Q1"}
    return out | ({"match_source_url": "https://www.wikidata.org/wiki/Q1"} if qid else {"wikipedia_url": "https://en.wikipedia.org/wiki/X", "match_source_url": "https://en.wikipedia.org/wiki/X"})


def test_enrichment_demotes(spark):
    master = [{"game_id": "ageofempires3", "representative_title": "Age of Empires 3", "normalized_title": "age of empires 3", "first_seen_year": "2006", "content_class": "game", "merge_confidence": "high"}, {"game_id": "absoluteblue", "representative_title": "Absolute Blue", "normalized_title": "absolute blue", "first_seen_year": "2005"}]
    issues = [issue("x", "CBS022006DVD") | {"game_id": "ageofempires3", "source_title": "Age of Empires 3 v 1", "source_normalized_title": "age of empires 3 v 1", "observed_title_variants": "Age of Empires 3 v 1; Age of Empires 3 v 1 01a", "source_normalized_variants": "age of empires 3 v 1; age of empires 3 v 1 01a"}, issue("y", "CBS082005DVD") | {"game_id": "absoluteblue", "source_title": "Absolute Blue", "source_normalized_title": "absolute blue"}]
    baseline = [match("Age of Empires III Remaster", "age of empires 3 v 1", "2020"), match("Age of Empires III Remaster", "age of empires 3 v 1 01a", "2020"), match("Q122", "absolute blue", "2018", qid=True)]
    rejections = [{"normalized_title": b["normalized_title"], "rejected_candidate": b["canonical_title"], "source": "wikimedia", "reason": "wrong one"} for b in baseline]
    t = enrich.enrich(frame(spark, S.PUBLISHED_ISSUES, issues), frame(spark, S.PUBLISHED_MASTER, master), frame(spark, ["normalized_title", *V.MATCH_FIELDS], baseline), frame(spark, S.REJECTIONS, rejections))
    m = {r.game_id: r for r in t["enriched_master_games"].collect()}
    assert {r.match_status for r in m.values()} == {"unmatched"} and {r.match_action for r in m.values()} == {"demoted_weak_alias_match"}
    assert "demoted_release_year_conflict" in m["ageofempires3"].match_notes and "demoted_raw_qid_title" in m["absoluteblue"].match_notes
    assert t["match_demotions"].count() == 2 and t["enriched_issue_titles"].count() == 2 and t["title_aliases"].count() == 3
    assert {r.game_id for r in t["unmatched_titles"].collect()} == {"ageofempires3", "absoluteblue"}
    a = enrich.audit(t).first()
    assert (a.master_rows, a.unmatched, a.demotions) == (2, 2, 2)


def test_match_conflict_and_backfill(spark):
    rows = [issue("Four Story", "CBS012009DVD", norm="four story"), issue("Four Story Demo", "CBS022009DVD", norm="four story demo")]
    base = [match("Four Story", "four story", "2008"), match("Q77", "four story demo", "2008", qid=True) | {"canonical_slug": "q77"}]
    master, _, _ = published(spark, rows, baseline=base)
    assert master[0].match_action == "retained_with_cluster_conflict" and master[0].canonical_title == "Four Story"
    assert "cluster_has_multiple_canonical_targets" in master[0].match_notes
    master, _, _ = published(spark, rows[1:], baseline=base)
    assert master[0].canonical_title == "Four Story Demo" and "canonical_title_backfilled_from_local_title" in master[0].match_notes


def test_resolution(spark):
    titles = frame(spark, ["normalized_title", "representative_title"], [{"normalized_title": n, "representative_title": t} for n, t in (("anno", "Anno 1602"), ("4 story", "4 Story"), ("none", "Zzz Unheard"), ("err", "Err Title"))])
    hit = "normalized_title string, source string, language string, variant_no int, place int, id string, label string, description string"
    hits = spark.createDataFrame([("anno", "wikidata", "en", 0, 0, "Q1", "", "1998 video game"), ("anno", "wikidata", "en", 0, 1, "Q2", "", "film"), ("anno", "wikidata", "de", 0, 0, "Q3", "", "video game"), ("4 story", "wikidata", "en", 0, 0, "Q4", "", ""), ("4 story", "wikidata", "en", 0, 1, "Q5", "", "")], hit)
    ent = "id string, labels map<string,string>, aliases map<string,array<string>>, sitelinks map<string,string>"
    entities = spark.createDataFrame([("Q1", {"en": "Anno 1602"}, {}, {"dewiki": "Anno 1602", "enwiki": "Anno 1602 (game)"}), ("Q2", {"en": "Anno 1602"}, {}, {}), ("Q3", {"en": "Anno 1602"}, {}, {}), ("Q4", {"en": "4 Story"}, {}, {}), ("Q5", {"de": "x"}, {"en": ["4 Story"]}, {})], ent)
    fails = spark.createDataFrame([("err", "HTTP Error 429: slow down")], "normalized_title string, error string")
    got = {r.normalized_title: r for r in resolve.resolve(titles, hits, entities, fails).collect()}
    assert (got["anno"].reference_status, got["anno"].reference_source, got["anno"].reference_url) == ("matched", "wikipedia-en", "https://en.wikipedia.org/wiki/Anno_1602_%28game%29")
    assert got["anno"].reference_confidence == "high" and got["anno"].wikidata_id == "Q1"
    assert got["4 story"].reference_status == "ambiguous" and got["4 story"].reference_url == ""
    assert got["none"].reference_status == "unmatched" and got["err"].failure_reason == "reference_lookup_rate_limited"
    r = spark.createDataFrame([tuple(got[k][c] for c in ("normalized_title", *S.REFERENCE)) for k in got], ", ".join(f"{c} string" for c in ("normalized_title", *S.REFERENCE)))
    assert resolve.attach(titles, r, S.REFERENCE).count() == 4
    with pytest.raises(KeyError):
        resolve.attach(titles, r.limit(1), S.REFERENCE)


def test_overlay(spark):
    base = {"issue_titles": frame(spark, S.ISSUE_TITLES, [issue("Stable Game", "A")]), "master_games": frame(spark, S.MASTER_GAMES, [{"normalized_title": "stable game"}]), "unresolved_issues": frame(spark, S.UNRESOLVED, [{"archive_name": "B.7z", "reason": "503\nbusy"}])}
    retry = {"issue_titles": frame(spark, S.ISSUE_TITLES, [issue("New Game", "B")]), "master_games": frame(spark, S.MASTER_GAMES, []), "unresolved_issues": frame(spark, S.UNRESOLVED, [])}
    t = overlay.merge(base, retry, base["unresolved_issues"])
    assert {k: v.count() for k, v in t.items()} == {"issue_titles": 2, "master_games": 2, "unresolved_issues": 0, "archives": 1, "titles": 1}
    again = overlay.merge(base, retry, base["unresolved_issues"])
    assert sorted(map(tuple, t["master_games"].collect())) == sorted(map(tuple, again["master_games"].collect()))
    with pytest.raises(overlay.ContractError):
        overlay.merge(base, retry, frame(spark, S.UNRESOLVED, [{"archive_name": "C.7z"}]))
    with pytest.raises(csvio.HeaderMismatch):
        overlay.merge(base | {"issue_titles": base["issue_titles"].drop("year")}, retry, base["unresolved_issues"])


def test_extraction_stages(spark):
    cand = "archive_name string, source_kind string, source_path string, candidate_title string, normalized_title string, confidence string, content_kind string"
    c = lambda a, k, t, conf="high": (a, k, "p", t, t, conf, "unknown")
    cheap = spark.createDataFrame([(*c("A", "archiveorg-ocr", t), "ocr", True) for t in "xyz"] + [(*c("B", "redump-title", "x"), "redump", False)], cand + ", strategy string, structured boolean")
    quick = spark.createDataFrame([c("A", "disc-exe-name", "q"), c("B", "disc-exe-name", "q")], cand)
    full = spark.createDataFrame([c("B", "disc-metadata-value", "f", "medium")], cand)
    records = spark.createDataFrame([("i", "A", "CBS0101", 2001, "CD"), ("i", "B", "CBS0102", 2002, "CD"), ("i", "C", "CBS0103", 2003, "CD")], "archive_item string, archive_name string, issue_code string, year int, variant string")
    found, way = extraction.resolved(records, cheap, quick, full)
    got = {r.archive_name: (r.resolution_path, r.unresolved) for r in way.collect()}
    assert got == {"A": ("ocr", False), "B": ("redump>disc-quick>disc-full", False), "C": ("disc-quick>disc-full", True)}
    assert {r.normalized_title for r in found.where("archive_name = 'A'").collect()} == {"x", "y", "z"}
    way = extraction.resolved(records, cheap, quick, full, "external-only")[1]
    assert {r.archive_name: (r.resolution_path, r.reason, r.unresolved) for r in way.collect()} == {"A": ("ocr", "structured external list", False), "B": ("redump", "cheap sources incomplete", True), "C": ("external", "cheap sources incomplete", True)}
    found2, way = extraction.resolved(records, cheap, quick, full, "disc-only", status=spark.createDataFrame([("B", "extract_failed", "bad archive")], "archive_name string, status string, error string"))
    assert {r.archive_name: (r.resolution_path, r.status) for r in way.collect()} == {x: ("disc-quick>disc-full", "extract_failed" if x == "B" else "ok") for x in "ABC"}
    assert {r.normalized_title for r in found2.collect()} == {"q", "f"}
    way = extraction.resolved(records, cheap, quick, full, validate=True)[1]
    assert {r.resolution_path for r in way.where("archive_name = 'A'").collect()} == {"ocr>disc-quick>disc-full"}
    way = extraction.resolved(records, cheap, quick, full, force=True)[1]
    assert {r.resolution_path for r in way.where("archive_name = 'A'").collect()} == {"ocr>disc-quick"}
    with pytest.raises(ValueError):
        extraction.resolved(records, cheap, quick, full, "other")

    def broken(_):
        raise RuntimeError("no page\nat all")

    got, runs = extraction.run_strategies(records, {"ocr": lambda r: cheap.where("strategy = 'ocr'").drop("strategy"), "broken": broken, "redump": lambda r: cheap.where("strategy = 'redump'").drop("strategy")})
    assert got.count() == 4 and {(r.strategy, r.archive_name, r.titles, r.error) for r in runs.where("archive_name = 'A' or strategy = 'broken'").collect()} == {("ocr", "A", 3, None), ("redump", "A", 0, None), *(("broken", x, 0, "RuntimeError: no page") for x in "ABC")}
    t = extraction.issue_titles(found, records)
    assert t.columns == S.ISSUE_TITLES and t.where("archive_name = 'B'").count() == 3
    state = spark.createDataFrame([("A", "ok"), ("B", "extract_failed")], "archive_name string, status string")
    assert {r.archive_name for r in extraction.pending(records, state, spark.createDataFrame([("B",)], "archive_name string")).collect()} == {"B", "C"}


def test_csv_edge(spark, tmp_path):
    df = spark.createDataFrame([("a", 'q"uo,te', "two\nlines"), ("b", "", " lead "), ("c", None, "")], "x string, y string, z string")
    csvio.write(df.withColumn("extra", F.lit(1)), str(tmp_path / "out"), ["x", "y", "z", "w"])
    back = csvio.read(spark, str(tmp_path / "out"), ["x", "y", "z", "w"])
    assert sorted(map(tuple, back.collect())) == [("a", 'q"uo,te', "two\nlines", ""), ("b", "", " lead ", ""), ("c", "", "", "")]
    with pytest.raises(csvio.HeaderMismatch):
        csvio.read(spark, str(tmp_path / "out"), ["y", "x", "z", "w"])
    assert csvio.read_optional(spark, str(tmp_path / "missing.csv"), ["x"]).count() == 0
    many = spark.range(500).selectExpr("cast(500 - id as string) x", "'two\nlines' y").repartition(5)
    csvio.write(many, str(tmp_path / "many"), ["x", "y"], ["x"])
    csvio.join_files(spark, str(tmp_path / "many"), str(tmp_path / "one.csv"))
    got = [(r.x, r.y) for r in csvio.read(spark, str(tmp_path / "one.csv"), ["x", "y"]).collect()]
    assert [x for x, _ in got] == sorted(str(500 - i) for i in range(500)) and {y for _, y in got} == {"two\nlines"}


def test_command_line(spark, tmp_path):
    from stemma.__main__ import main

    raw = {"issue_titles": frame(spark, S.ISSUE_TITLES, [issue("Prince of Persia"), issue("Needfor Speed Carbonv 14"), issue("Setup", norm="setup")]), "master_games": frame(spark, S.MASTER_GAMES, []), "unresolved_issues": frame(spark, S.UNRESOLVED, [{"archive_name": "B.7z", "reason": "HTTP 503\nbusy"}])}
    from stemma.plans.export import export

    at = lambda x: str(tmp_path / x)
    assert export(raw, at("results/raw-20260301"), True) == list(raw)
    main(["publish", "--results", at("results"), "--output-dir", at("published"), "--single-files"])
    assert "`network/download`: 1" in (tmp_path / "published/unresolved_summary.md").read_text()
    main(["enrich", "--input-master", at("published/publishable_master_games.csv"), "--input-issues", at("published/publishable_issue_titles.csv"), "--output-dir", at("enriched"), "--single-files"])
    assert (tmp_path / "enriched/enriched_master_games.csv").read_text().count("\n") == 3 and "unmatched: 2" in (tmp_path / "enriched/enrichment_audit.md").read_text()
    retry = raw | {"issue_titles": frame(spark, S.ISSUE_TITLES, [issue("New Game", "B")]), "unresolved_issues": frame(spark, S.UNRESOLVED, [])}
    export(retry, at("retry"), True)
    main(["merge", "--base-dir", at("results/raw-20260301"), "--retry-dir", at("retry"), "--base-published-unresolved", at("published/final_unresolved_issues.csv"), "--output-dir", at("merged")])
    assert "titles added: 4" in (tmp_path / "merged/comparison.md").read_text()
    main(["audit", "--raw-dir", at("results/raw-20260301"), "--published-dir", at("published"), "--output-dir", at("audit"), "--rerun"])
    assert "Verdict: ready" in (report := (tmp_path / "audit/release_audit.md").read_text()) and "blocker" not in report


def test_snapshots(spark, tmp_path):
    for name, files in (("run-20260301", ["a", "b"]), ("run-20260305", ["a"]), ("other", ["a", "b"])):
        (tmp_path / name).mkdir()
        for f in files:
            (tmp_path / name / f).write_text("")
    latest = lambda *a: snapshots.latest_folder(spark, str(tmp_path), *a)
    assert latest().endswith("20260305") and latest(None, ("a", "b")).endswith("20260301") and latest("20260301") is None
    d = spark.createDataFrame([("20260101",), ("20260203",)], "d string")
    assert snapshots.latest(d, "d").first().d == "20260203" and snapshots.latest(d, "d", "20260203").first().d == "20260101"


def test_stream_state(spark, tmp_path):
    from stemma.streaming import incremental

    schema = "user int, ts timestamp, id int, v string"
    rows = [(1, "2024-01-01 00:00:00", 1, "a"), (2, "2024-01-01 01:00:00", 2, "b"), (1, "2024-01-02 00:00:00", 3, "c"), (3, "2024-01-03 00:00:00", 4, "d")]
    all_ = spark.createDataFrame(rows, "user int, ts string, id int, v string").withColumn("ts", F.to_timestamp("ts"))
    for day in (1, 2, 3):
        all_.where(F.dayofmonth("ts") == day).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    from stemma.sources.state import State

    state = State(spark, str(tmp_path / "state"), schema, "user", buckets=3)
    run = lambda: incremental.run_stream(spark, str(tmp_path / "in"), schema, state, str(tmp_path / "check"), [F.col("ts"), F.col("id")])
    want = [(1, "c"), (2, "b"), (3, "d")]
    assert sorted((r.user, r.v) for r in run().read().collect()) == want
    before = state.version()
    assert sorted((r.user, r.v) for r in run().read().collect()) == want and state.version() == before  # nothing new
    again = State(spark, str(tmp_path / "days"), schema, "user")
    assert incremental.batches(again, all_.withColumn("day", F.to_date("ts")), "day", [F.col("ts"), F.col("id")]) == 3
    assert sorted((r.user, r.v) for r in again.read().collect()) == want
    first = State(spark, str(tmp_path / "first"), schema, "user")
    incremental.insert_stream(spark, str(tmp_path / "in"), schema, first, str(tmp_path / "check1"), [F.col("ts")])
    assert sorted((r.user, r.v) for r in first.read().collect()) == [(1, "a"), (2, "b"), (3, "d")]
    all_.where("id = 3").withColumn("id", F.lit(9)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    incremental.insert_stream(spark, str(tmp_path / "in"), schema, first, str(tmp_path / "check1"), [F.col("ts")])
    assert sorted((r.user, r.id) for r in first.read().collect()) == [(1, 1), (2, 2), (3, 4)]  # kept for good


def test_progress_stream(spark):
    import time

    from stemma.streaming import incremental

    sent, n = [], [1]
    q = incremental.progress_stream(spark, lambda: spark.createDataFrame([(n[0],)], "n int"), sent.append, "1 seconds")
    try:
        until = time.time() + 60
        while len(sent) < 2 and time.time() < until:
            if sent:
                n[0] = 2
            time.sleep(0.2)
    finally:
        q.stop()
    assert sent == ['{"n":1}', '{"n":2}']


def test_release_audit(spark):
    from stemma.plans import release

    master = spark.createDataFrame([(f"g{i}", f"game {i}", f"Game {i}" if i else "Some software", str(i % 5), "1", "A", "k") for i in range(30)], "game_id string, normalized_title string, representative_title string, issue_count string, occurrence_count string, first_seen_issue string, source_kinds string")
    issues = spark.createDataFrame([("2004", "CBS122004DVD", "a", "game 1", "Game 1", "k"), ("2004", "X", "b", "game 2", "Game 2", "k"), ("2008", "Y", "c", "game 3", "Some software", "k")], "year string, issue_code string, archive_name string, normalized_title string, representative_title string, source_kinds string")
    s = release.sample(master, issues, top=5, extra=5)
    assert s.columns == S.SAMPLE
    buckets = {(r.sample_bucket, r.row_kind): r["count"] for r in s.groupBy("sample_bucket", "row_kind").count().collect()}
    assert buckets == {("top-5-by-issue-count", "master"): 5, ("random-5-seed-1", "master"): 5, ("noisy-issue:CBS122004DVD", "issue"): 1, ("late-year-seed-1:Y", "issue"): 1}
    h = {(r.sample_bucket, r.classification): r.n for r in release.histogram(s).collect()}
    assert h["late-year-seed-1:Y", "drop"] == 1 and sum(n for (b, _), n in h.items() if b is None) == 12
    files = spark.createDataFrame([("a.md", "x /home/me PhysX Ã"), ("b.md", "fine")], "path string, text string")
    assert {tuple(r) for r in release.text_findings(files).collect()} == {("a.md", "literal", "/home/"), ("a.md", "noise", "physx"), ("a.md", "mojibake", "1")}
    readme = spark.createDataFrame([("master titles: `12`\n## Full Table\n| Title | Issue | N |\n| --- | --- | --- |\n| Anno | A | 2 |\n| x |",)], "text string")
    assert [tuple(r)[1:] for r in release.readme_rows(readme).collect()] == [("Anno", "A", "2")]
    assert release.readme_counts(readme, {"m": r"master titles: `(\d+)`", "n": r"rows: (\d+)"}).first() == (12, None)
    assert release.verdict({"x": files}, {})[0] == "not ready" and release.verdict({"x": files.limit(0)}, {"y": files}) == ("ready with caveats", [], ["y"])
    assert release.same_rows(files, files.orderBy(F.desc("path"))) and not release.same_rows(files, files.limit(1))
    u = publish.unresolved(frame(spark, S.UNRESOLVED, [{"reason": "HTTP 503\nx"}, {"reason": "other"}]))
    assert u.columns == S.FINAL_UNRESOLVED and release.cause_report(u).count("`network/download`: 1") == 1
    assert release.tracked_difference(files.select("path"), spark.createDataFrame([("a.md",), ("c.md",)], "path string"), files.select("path").limit(0)).count() == 2


def test_state(spark, tmp_path):
    from stemma.sources import state

    s = state.State(spark, str(tmp_path / "s"), "k string, v string", "k", buckets=2)
    assert s.read().count() == 0
    rows = lambda *x: spark.createDataFrame(list(x), "k string, v string")
    s.upsert(rows(("a", "1"), ("b", "1"), ("a", "2")), [F.col("v")])
    s.upsert(rows(("b", "3"), ("c", "4")), [F.col("v")])
    assert sorted(map(tuple, s.read().collect())) == [("a", "2"), ("b", "3"), ("c", "4")]
    s.append(rows(("a", "9")))
    s.replace_all(rows(("a", "x"), ("a", "y")), "k")
    assert sorted(map(tuple, s.read().collect())) == [("a", "x"), ("a", "y"), ("b", "3"), ("c", "4")] and s.version() == 3
    s.clean(1)
    assert sorted(map(tuple, s.read().collect())) == [("a", "x"), ("a", "y"), ("b", "3"), ("c", "4")]
    assert not any(f.startswith("bucket=") for f in snapshots.folders(spark, str(tmp_path / "s" / "v=0")) if (0, int(f[7:])) not in {(v, b) for b, x in s.manifest(3).items() for v in x})
    s.replace_all(rows(("z", "y")), "v")  # units of another column lie in any bucket
    assert sorted(map(tuple, s.read().collect())) == [("a", "x"), ("b", "3"), ("c", "4"), ("z", "y")]
    d, new = state.changed(rows(("a", "1")), None)
    assert new and state.changed(rows(("a", "1")), d) == (d, False)


def test_cache_and_pages(spark):
    cache = spark.createDataFrame([("k1", "p", None), ("k2", None, "failed")], "cache_key string, payload string, error string")
    fetched = spark.createDataFrame([("k3", "q", None)], "cache_key string, payload string, error string")
    known, todo = extraction.cached(spark.createDataFrame([("k1",), ("k2",), ("k3",), ("k4",)], "cache_key string"), cache, fetched)
    assert {r.cache_key: (r.payload, r.error) for r in known.collect()} == {"k1": ("p", None), "k2": (None, "failed"), "k3": ("q", None), "k4": (None, None)}
    assert {r.cache_key for r in todo.collect()} == {"k3", "k4"}
    from stemma.operators import extract

    page = "<p>Enthaltene Vollversionen:</p> <table><tr><td> <a href=\"/programm/x\">Mystery Island</a></td><td><a href=\"/programm/y\">Anno 1602</a></td></tr></table><td><a href=\"/programm/z\">Other</a></td>"
    p = spark.createDataFrame([("i", "u", page, "<li>Some Magazine: Icewind Dale</li>")], "issue string, source_path string, html string, hits string")
    got = extract.table_candidates(p, ["issue"], "html", "Enthaltene Vollversionen:", "/programm/", "vollversion-fullversion")
    assert {r.normalized_title for r in got.collect()} == {"mystery island", "anno1602"}
    assert [r.normalized_title for r in extract.phrase_candidates(p, ["issue"], "hits", "Some Magazine", "redump-title", "search").collect()] == ["icewind dale"]
    q = spark.createDataFrame([("CBS0111Gold", 2011, "Gold")], "c string, y int, v string")
    assert q.select(extract.issue_queries(F.col("c"), F.col("y"), F.col("v"), "M")).first()[0] == ['"M" "CBS0111Gold"', '"M" "01/2011"', '"M" "01/11"', '"M" "01/11" "Gold"']
    f = spark.createDataFrame([("a/b.ini", 10, None), ("a/b/c/d.ini", 10, None), ("x.exe", 1, None), ("y.txt", 1 << 20, None)], "path string, length bigint, is_link boolean")
    assert [r.path for r in extract.metadata_files(f).collect()] == ["a/b.ini"]


def test_published_games_alone(spark):
    """The master table by itself is that of the whole plan; titles that are never published are not looked at."""
    def row(title, kinds="vollversion-fullversion", issue="CBS0101"):
        return dict.fromkeys(S.ISSUE_TITLES, "x") | {"issue_code": issue, "year": "2001", "representative_title": title, "normalized_title": title.lower(), "source_kinds": kinds, "confidence": "high", "content_kind": "demo"}

    titles = ["Lordofwar Demo", "Lord of War", "Lord of War v 1.0", "Prim r", "Map Editor", "Skype", "Ageof Wonders", "Héros – der Insel", "Werbung", "Zoo", "Zoo0", "x"]
    rows = [row(t, k, i) for t in titles for k in ("vollversion-fullversion", "disc-metadata-value", "disc-manifest-path") for i in ("CBS0101", "CBS0202")]
    baseline = frame(spark, ["normalized_title", *V.MATCH_FIELDS], [dict.fromkeys(V.MATCH_FIELDS, "") | {"normalized_title": "zoo", "match_status": "matched", "canonical_title": "Zoo Park"}])
    rejected = frame(spark, S.REJECTIONS, [{"normalized_title": "zoo", "rejected_candidate": "Zoo Park", "source": "", "reason": "another"}])
    args = (frame(spark, S.ISSUE_TITLES, rows), baseline, frame(spark, S.OVERRIDES, []), rejected)
    alone, whole = publish.published_master(*args), publish.publish(*args)["publishable_master_games"]
    assert alone.columns == whole.columns and alone.count() >= 4
    assert alone.exceptAll(whole).count() == whole.exceptAll(alone).count() == 0


def test_class_folds_a_title_once(spark):
    """Each rule looks at the same folded title; the look at all rules at once agrees with them."""
    from stemma.functions import rules as R

    df = spark.createDataFrame([(t,) for t in ("Map Editor", "Skype 3", "Héros Mod", "Cheats", "Werbung", "a", "Mod Kit", "Backupper", "", None)], "t string")
    plan = df.select(R.content_class(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    once = df.select(R.public_title(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("octet_length") == once.count("octet_length")
    got = df.select(R.content_class(F.col("t")).alias("c"), R.class_named(R.public_title(F.col("t"))).alias("some"), R.public_title(F.col("t")).isin(V.NOISE_TITLES).alias("noise")).collect()
    assert all((r.c != "game") <= (r.some or r.noise) for r in got) and {r.some for r in got} == {True, False}
