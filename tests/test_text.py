import html
import random
from urllib.parse import quote

from pyspark.sql import functions as F

from stemma.functions import rules as R
from stemma.functions import text as T
from stemma.functions.fold import ascii_fold, folded


def test_fold(one):
    words = ["Straße ẞ", "Élan vital", "naïve café", None, "é"]
    assert one(ascii_fold, *words) == ["Strasse SS", "Elan vital", "naive cafe", "", "e"]
    r = random.Random(1)
    chars = lambda: (chr(r.choice([r.randrange(32, 0x250), r.randrange(32, 0x2500), r.randrange(32, 0xD800), r.randrange(0xE000, 0x2FFFF)])) for _ in range(r.randrange(12)))
    odd = ["ﬁnal Ａge ½ Ⅳ … 한글 ẞ", "\x01\x02 Ａ", *("".join(chars()) for _ in range(2000))]
    assert one(ascii_fold, *odd) == [folded(x) for x in odd]
    assert one(T.public_title, "ﬁnal Ａge ½", "Ⅳ") == ["final age 1 2", "iv"]


def test_character_references(one):
    r = random.Random(2)
    names = list(T.NAMED)
    numbers = ["0", "13", "65", "128", "150", "159", "8364", "55296", "1114111", "1114112", "11", "65534", "1234567890", "65279", "x41", "X1F600", "xe4", "xFFFF", "xzz", "xfdd0"]
    piece = lambda: r.choice([lambda: "&" + r.choice(names), lambda: "&#" + r.choice(numbers) + r.choice([";", ""]), lambda: r.choice(["&", "&#;", "&unknown;", "&notit;", "&ampx", "&amp;lt;", "a", "ä ", ";", "<"])])()
    texts = ["".join(piece() for _ in range(r.randrange(8))) for _ in range(1500)]
    assert one(T.unescaped, *texts) == [html.unescape(t) for t in texts]
    assert one(T.html_text, "<p>M&uuml;ller &#38; S&#246;hne</p>") == ["\nMüller & Söhne\n"]


def test_page_addresses(one):
    titles = ["A*B~c/d (x) é+", "Anno 1602", "50% & more", "Ω_-."]
    assert one(lambda c: T.wiki_url("de", c), *titles) == ["https://de.wikipedia.org/wiki/" + quote(t.replace(" ", "_")) for t in titles]


def test_spaces_and_keys(one):
    assert one(T.normalize_spaces, "  a–b  c , d ", "Re-Awakening", "_x_/", None) == ["a - b c, d", "Re - Awakening", "x", ""]
    assert one(T.public_title, "Command & Conquer: Generäle!", "") == ["command and conquer generale", ""]
    assert one(T.slug, "Command & Conquer!") == ["command-and-conquer"]
    assert one(T.cluster_key, "Age of Empires 3 v 1", "Age of Empires 3 v 1 01a", "X Demo", "Need for Speed Bonus") == ["ageofempires3", "ageofempires3", "x", "needforspeed"]


def test_split_and_strip(one):
    assert one(T.split_camel, "NeedForSpeed2", "A12", "ABCdef", "Conquer3 Kanev105", None) == ["Need For Speed 2", "A12", "AB Cdef", "Conquer 3 Kanev 105", ""]
    got = one(T.strip_suffixes, "Title Demo v 1.2", "Title (Demo)", "Plain", "Carbonv 14", "", "Age of Empires Gold Edition")
    assert [(r.text, r.descriptor, r.version) for r in got] == [("Title", True, True), ("Title", True, False), ("Plain", False, False), ("Carbon", False, True), ("", False, False), ("Age of Empires Gold Edition", False, False)]


def test_titles(one):
    assert one(T.normalized_title, "codename panzers phase 2 v 1", "setup", "Anno1602", None, "ab") == ["codename panzers phase 2v 1", None, "anno1602", None, None]
    assert one(T.title_fragment, "CBS/Demo/ANNO1602DEMO.exe", "PRO 3.3") == ["ANNO1602", "PRO 3"]
    assert one(T.title_from_command, '"Games/Anno1602/start.exe",0', "setup.exe /x", "") == ["Anno1602", None, None]
    assert one(T.strip_version, "Arena Wars v 1 1") == ["Arena Wars"]
    v = one(T.search_variants, "Arena Wars v 1 1")[0]
    assert v[0] == "Arena Wars v 1 1" and "Arena Wars" in v


def test_archive_names(one):
    got = one(T.archive_name, "2000/CBS092000.7z", "2011/CBS0111.7z", "2011/CBS0111Gold.7z", "2017/CBS0917Platin.7z", "x/CBS1399.7z", "x.zip", None)
    assert [(r.year, r.code, r.variant) if r else None for r in got] == [(2000, "CBS092000", "CD"), (2011, "CBS0111", "Standard"), (2011, "CBS0111Gold", "Gold"), (2017, "CBS0917Platin", "Platin"), None, None, None]


def test_html_and_lists(one):
    assert one(T.html_text, "<p>a&amp;b<br>c</p><b>d</b>") == ["\na&b\nc\n d "]
    assert one(T.list_items, "• a; b | c", "a, b, c", "a, b", "") == [["a", "b", "c"], ["a", "b", "c"], ["a, b"], []]
    assert one(T.lenient_int, "2005.9", "", "x", " 7 ") == [2005, None, None, 7]
    assert one(T.public_reason, "HTTP Error 429: x", "urlopen error", "other ", None) == ["reference_lookup_rate_limited", "reference_lookup_failed", "other", ""]
    assert one(T.safe_name, "a b/c", "...") == ["a_b_c", "archive"]
    assert one(T.list_value, '["a", " "]', '"x"', None)[:2] == [["a"], ["x"]]


def test_rules(one, spark):
    assert one(R.content_class, "WEBDESmart Surfer", "Map Editor", "Cheats", "Total Conversion", "Mod Kit", "X Add-On", "Anno") == ["utility", "editor_sdk", "disc_noise", "mod_or_conversion", "editor_sdk", "expansion_or_addon", "game"]
    assert one(R.content_kind, "Vollversionen", "Demos", "Bonus", "Inhalt", "x") == ["full_version", "demo", "bonus", "unknown", "unknown"]
    rows = [("Anno 1602", "anno 1602", "disc-metadata-value"), ("x", "12345", "x"), ("Setup", "setup x", "x"), ("Icewind", "icewind", "x"), ("foobar", "foobar", "x"), ("Any", "any", "vollversion-fullversion,x"), ("Sound files", "sound files", "disc-manifest-path")]
    df = spark.createDataFrame(rows, "t string, n string, k string")
    got = [r[0] for r in df.select(R.title_reason(F.col("t"), F.col("n"), F.col("k"))).collect()]
    assert got == ["multiword", "numeric-only", "bad-substring", "singleword-titlecase", "weak-singleword", "vollversion-fullversion", "manifest-noise"]
    s = one(R.sample_class, "Knights of Honor", "Some software", "Game v 12", "Ageof Kings", "abcdefghijklmnopqrstuv", "Anno")
    assert [r.classification for r in s] == ["keep", "drop", "uncertain", "uncertain", "uncertain", "keep"]
    assert one(R.description_points, "a video game", "a film", "a video game about a film", "x") == [18, -18, 0, 0]
