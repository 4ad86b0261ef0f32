"""Text normalization as column expressions: all native, all null-safe (a null is the empty text unless said otherwise)."""

from __future__ import annotations

from functools import reduce
from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .fold import ascii_fold

#: Typographic dashes, quotes and the no-break space, and what they become.
ODD, PLAIN = "‐‑‒–—―‘’“” ", "------''\"\" "
#: So many characters from the end hold any descriptor without a number, with a line end behind it.
LOOK = 24
#: Texts that normalize_spaces leaves alone: usual words in single blanks or hyphens between blanks.
LETTER = r"A-Za-z0-9À-ÖØ-öø-ÿ'\"().&"
WORD = f"[{LETTER}][{LETTER},;:!?]*+"
NORMAL = rf"^{WORD}(?: (?:- )?{WORD})*+\z"


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def safe(c: Column) -> Column:
    """Missing is empty; so is a number that is not a number."""
    return F.coalesce(c.cast("string"), F.lit(""))


def alternation(patterns) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def contains_any(c: Column, parts) -> Column:
    """Whether the text holds one of these literals."""
    return reduce(lambda a, b: a | b, [c.contains(p) for p in parts], F.lit(False))


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def strip_chars(c: Column, chars: str) -> Column:
    return F.btrim(c, F.lit(chars))


def normalize_spaces(c: Column) -> Column:
    """Plain dashes, quotes and single blanks; none before punctuation; hyphens between blanks; no fringe of ' -_/'."""

    def full(c: Column) -> Column:
        c = squeezed(F.translate(c, ODD, PLAIN))
        c = F.regexp_replace(c, r"\s+([,;:!?])", "$1")
        c = F.regexp_replace(c, r"\s*-\s*", " - ")
        return strip_chars(F.regexp_replace(c, r"\s+", " "), " -_/")

    return let(F.coalesce(c, F.lit("")), lambda c: F.when(c.rlike(NORMAL), c).otherwise(full(c)))


def letters_and_digits(c: Column, glue: str) -> Column:
    return F.btrim(F.regexp_replace(F.replace(F.lower(ascii_fold(c)), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", glue), F.lit(glue))


def public_title(c: Column) -> Column:
    """Folded, lower case, letters and digits in single blanks."""
    return letters_and_digits(c, " ")


def slug(c: Column) -> Column:
    return letters_and_digits(c, "-")


def cluster_key(c: Column) -> Column:
    """The key that spellings of a title share: its public form without one trailing descriptor of each sort, no blanks."""
    return key_of(public_title(c))


def key_of(public: Column) -> Column:
    """cluster_key of a title in its public form."""
    short = lambda c: reduce(lambda x, p: F.trim(F.regexp_replace(x, p, "")), V.KEY_TAILS, c)
    # One look tells most titles from those that have a descriptor.
    return F.replace(let(public, lambda c: F.when(c.rlike("[0-9]") | F.right(c, F.lit(LOOK)).rlike(V.KEY_LOOK), short(c)).otherwise(c)), F.lit(" "), F.lit(""))


def split_camel(c: Column) -> Column:
    """Blanks at lower/upper boundaries, before the last capital of a run, and between letters and digits."""

    def one(t: Column) -> Column:
        s = F.regexp_replace(t, "(?<=[a-z])(?=[A-Z])", " ")
        s = F.regexp_replace(s, "(?<=[A-Z])(?=[A-Z][a-z])", " ")
        s = F.regexp_replace(s, r"(?<=[A-Za-z]{2})(?=\d{1,4}\b)", " ")
        s = F.regexp_replace(s, r"(?<=\d)(?=[A-Za-z]{2,})", " ")
        # One look tells most words from those that any of the four could change.
        return F.when(~t.rlike(r"[a-z][A-Z]|[A-Z][A-Z][a-z]|\d") | t.rlike(r"^[A-Za-z]\d+$"), t).otherwise(s)

    return normalize_spaces(F.array_join(F.transform(F.split(F.trim(F.coalesce(c, F.lit(""))), r"\s+"), one), " "))


def without_tails(c: Column, patterns) -> Column:
    return reduce(lambda x, p: F.trim(F.regexp_replace(x, f"(?i){p}", "")), patterns, c)


def strip_suffixes(c: Column) -> Column:
    """Struct (text, descriptor, version): disc descriptors and versions taken from the end until nothing changes, and
    whether any was taken. A pass that changes nothing ends the work; the rest of the loop only hands its state on."""

    def step(s: Column) -> Column:
        t = s["text"]
        two = let(without_tails(t, V.DESCRIPTOR_SUFFIXES), lambda x: F.struct(x.alias("x"), without_tails(x, V.VERSION_SUFFIXES).alias("y")))

        def after(p: Column) -> Column:
            d, v = p["x"] != t, p["y"] != p["x"]
            return F.struct(normalize_spaces(p["y"]).alias("text"), (s["descriptor"] | d).alias("descriptor"), (s["version"] | v).alias("version"), (d | v).alias("changed"))

        return let(two, after)

    def loop(c: Column) -> Column:
        start = F.struct(c.alias("text"), F.lit(False).alias("descriptor"), F.lit(False).alias("version"), F.lit(True).alias("changed"))
        end = F.aggregate(F.sequence(F.lit(0), F.length(c)), start, lambda s, _: F.when(s["changed"], step(s)).otherwise(s))
        return let(end, lambda s: F.struct(s["text"].alias("text"), s["descriptor"].alias("descriptor"), s["version"].alias("version")))

    # One look tells most titles from those that a pass could change.
    some = lambda c: (c.rlike("[0-9]") | F.right(c, F.lit(LOOK)).rlike(V.SUFFIX_LOOK)) & c.rlike(f"(?i){alternation(V.DESCRIPTOR_SUFFIXES + V.VERSION_SUFFIXES)}")
    same = lambda c: F.struct(normalize_spaces(c).alias("text"), F.lit(False).alias("descriptor"), F.lit(False).alias("version"))
    return let(F.coalesce(c, F.lit("")), lambda c: F.when((F.trim(c) == c) & ~some(c), same(c)).otherwise(loop(c)))


def repair_tokens(c: Column) -> Column:
    """The fixed repairs of glued words, one after another."""
    repaired = reduce(lambda x, p: F.regexp_replace(x, rf"\b{p[0]}\b", p[1]), V.TOKEN_REPAIRS, c)
    # All of them are plain words, which are found faster than a pattern with their borders.
    return normalize_spaces(F.when(contains_any(c, [p[0] for p in V.TOKEN_REPAIRS]), repaired).otherwise(c))


def stem(c: Column) -> Column:
    """The last path part without its last suffix; a dot at either end is no suffix."""
    name = F.element_at(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), "/+$", ""), "/"), -1)
    return let(name, lambda n: F.when(n.contains(".") & n.rlike(r"^.+\.[^.]+$"), F.regexp_replace(n, r"\.[^.]*$", "")).otherwise(n))


def title_fragment(c: Column) -> Column:
    """A title made from a file name: separators and camel case as blanks, no trailing word of the trade."""
    t = F.regexp_replace(stem(c), r"[_\-.]+", " ")
    t = F.regexp_replace(t, "(?<=[a-z0-9])(?=[A-Z])", " ")
    trade = "(?i)(demo|setup|install|launcher|autorun|uninstall|patch)$"
    t = let(t, lambda t: F.when(F.right(t, F.lit(LOOK)).rlike(trade), F.regexp_replace(t, trade, "")).otherwise(t))
    return strip_chars(F.regexp_replace(t, r"\s+", " "), " '\"-_.,:/\\")


def normalized_title(c: Column) -> Column:
    """Lower-case words without the generic ones; null if fewer than three characters stay."""
    t = F.trim(F.lower(F.regexp_replace(title_fragment(c), "[^A-Za-z0-9]+", " ")))
    glued = lambda t: F.regexp_replace(F.regexp_replace(t, r"(?<=[a-z])\s+(?=\d{2,4}\b)", ""), r"(?<=\d)\s+(?=[a-z]\b)", "")
    t = let(t, lambda t: F.when(t.rlike("[0-9]"), glued(t)).otherwise(t))
    generic = list(dict.fromkeys(V.GENERIC_SEGMENTS + V.GENERIC_WORDS_MORE))
    words = F.filter(F.split(t, r"\s+"), lambda w: (w != "") & ~w.isin(generic))
    return let(words, lambda w: F.when(F.length(F.array_join(w, "")) >= 3, F.array_join(w, " ")))


def reference_title(c: Column) -> Column:
    """As public_title, but sharp s is dropped like any other character that has no plain form."""
    return public_title(F.translate(F.coalesce(c, F.lit("")), "ßẞ", ""))


def strip_version(c: Column) -> Column:
    for p in V.VERSION_TAILS:
        c = F.trim(F.regexp_replace(F.trim(c), p, ""))
    return c


def search_variants(c: Column) -> Column:
    """Up to four different spellings to look a title up by, in order."""
    plain = F.trim(F.translate(c, "’`–—", "''--"))
    bare = strip_version(plain)
    all_ = F.array(F.trim(c), plain, bare, squeezed(F.replace(bare, F.lit("-"), F.lit(" "))))
    return F.array_distinct(F.filter(all_, lambda x: x != ""))


#: The named characters of the standard, and those of them that also count without a semicolon, longest first.
NAMED = dict(entities.html5)
BARE = sorted((n for n in NAMED if not n.endswith(";")), key=lambda n: (-len(n), n))
#: Numbers that stand for another character than their own.
INSTEAD = {0: "\ufffd", 0x0D: "\r"} | {n: bytes([n]).decode("cp1252", "replace").replace("\ufffd", chr(n)) for n in range(0x80, 0xA0)}


def numbered(digits: Column) -> Column:
    """The character of a number: decimal, or after an x hexadecimal. Surrogates and numbers beyond the last character give
    the replacement character, control characters and other code points for nothing the empty text."""
    code = F.when(digits.rlike("^[xX]"), F.conv(F.substring(digits, F.lit(2), F.length(digits)), 16, 10)).otherwise(digits)
    big = F.length(F.regexp_replace(code, "^0+", "")) > 7
    n = F.when(big, F.lit(0x110000)).otherwise(F.regexp_replace(code, "^0+(?=.)", "").cast("int"))

    def char(n: Column) -> Column:
        odd = first_of_map({str(k): v for k, v in INSTEAD.items()}, n.cast("string"))
        out = (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        none = n.between(1, 8) | n.between(0x0E, 0x1F) | n.between(0x7F, 0x9F) | n.between(0xFDD0, 0xFDEF) | (n == 0x0B) | (n.bitwiseAND(0xFFFE) == 0xFFFE)
        text = F.when(n == 0xFEFF, F.lit("\ufeff")).otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        return F.when(odd.isNotNull(), odd).when(out, F.lit("\ufffd")).when(none, F.lit("")).otherwise(text)

    return let(n, char)


def first_of_map(entries: dict[str, str], key: Column) -> Column:
    """The value of a fixed table for a key, null without one; the table becomes a constant of the plan."""
    return F.try_element_at(F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in entries.items())), F.lit("\x01"), F.lit("\x02")), key)


def unescaped(c: Column) -> Column:
    """Character references resolved as browsers do: numbers, named ones, and the old names without a semicolon, also as the
    beginning of a longer word."""

    def one(p: Column) -> Column:
        number = r"^#([0-9]+|[xX][0-9a-fA-F]+)"
        name = F.regexp_extract(p, r"^[^\t\n\f <&#;]{1,32};?", 0)

        def found(x: Column) -> Column:
            rest = F.substring(p, F.length(x["name"]) + 1, F.length(p))
            old = F.regexp_extract(p, f"^(?:{'|'.join(BARE)})", 0)
            named = F.when(x["value"].isNotNull(), F.concat(x["value"], rest)).when(old != "", F.concat(first_of_map({n: NAMED[n] for n in BARE}, old), F.substring(p, F.length(old) + 1, F.length(p))))
            return F.when(p.rlike(number), F.concat(numbered(F.regexp_extract(p, number, 1)), F.regexp_replace(p, number + ";?", ""))).otherwise(F.coalesce(named, F.concat(F.lit("&"), p)))

        return let(F.struct(name.alias("name"), F.when(name != "", F.coalesce(first_of_map(USUAL, name), first_of_map(NAMED, name))).alias("value")), found)

    def whole(parts: Column) -> Column:
        return F.array_join(F.concat(F.slice(parts, 1, 1), F.transform(F.slice(parts, F.lit(2), F.size(parts)), one)), "")

    return F.when(c.contains("&"), let(F.split(c, "&"), whole)).otherwise(c)


#: Looked up before all others.
USUAL = {n: NAMED[n] for n in ("amp;", "nbsp;", "lt;", "gt;", "quot;", "auml;", "ouml;", "uuml;", "szlig;", "copy;", "middot;", "apos;", "eacute;", "ndash;", "mdash;", "hellip;")}


def html_text(c: Column, references: list[tuple[str, str]] | None = None) -> Column:
    """Markup to lines of text: breaks and blocks as line ends, other tags as blanks, character references resolved: all, as
    browsers do, or only these, one after another."""
    for p, by in V.MARKUP:
        c = F.regexp_replace(c, p, by)
    c = unescaped(c) if references is None else reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), references, c)
    return F.regexp_replace(F.replace(c, F.lit("\r"), F.lit("\n")), r"\n{3,}", "\n\n")


def list_items(c: Column) -> Column:
    """The items of a line: parts between bullets, bars, slashes, stars or dashes; commas only if there are two or more and
    nothing else parts it."""
    fringe = " -*•\t"
    t = F.regexp_replace(F.trim(c), r"^[\s*•\-]+", "")

    def parts(t: Column) -> Column:
        p = F.split(t, V.ITEM_MARKS)
        return F.when((F.size(p) == 1) & (F.regexp_count(t, F.lit(",")) >= 2), F.split(t, ",")).otherwise(p)

    return F.filter(F.transform(let(t, parts), lambda x: strip_chars(x, fringe)), lambda x: x != "")


def noise_title(norm: Column) -> Column:
    """Whether a normalized title names nothing: null, the magazine, a generic part, an issue code."""
    bare = F.replace(norm, F.lit(" "), F.lit(""))
    return norm.isNull() | norm.isin(V.GENERIC_TITLES) | norm.startswith(V.GENERIC_TITLES[0]) | bare.isin(V.GENERIC_SEGMENTS) | bare.rlike(r"^(cb|cbs)\d{3,4}[a-z]*$")


def title_from_parts(parts: Column) -> Column:
    """The right-most path part that is a title; null without one."""
    some = F.filter(F.transform(F.reverse(parts), lambda p: F.struct(title_fragment(p).alias("t"), normalized_title(title_fragment(p)).alias("n"))), lambda x: (x["t"] != "") & ~noise_title(x["n"]))
    return F.get(some, 0)["t"]


def title_from_command(c: Column) -> Column:
    """The title in a command: the program's name, else the folders above it."""
    raw = F.trim(F.split_part(strip_chars(F.trim(c), '"'), F.lit(","), F.lit(1)))
    raw = let(raw, lambda r: F.when(r.contains(" ") & ~F.lower(r).endswith(".exe"), F.split_part(r, F.lit(" "), F.lit(1))).otherwise(r))
    folders = lambda r: F.filter(F.slice(F.split(r, "/"), F.lit(1), F.greatest(F.size(F.split(r, "/")) - 1, F.lit(0))), lambda p: p != "")
    return let(raw, lambda r: F.when(r == "", None).otherwise(F.when(normalized_title(title_fragment(r)).isNotNull(), title_fragment(r)).otherwise(title_from_parts(folders(r)))))


def safe_name(c: Column) -> Column:
    t = strip_chars(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[^\p{Alnum}_.-]", "_"), "._")
    return F.when(t == "", F.lit("archive")).otherwise(t)


def archive_name(c: Column) -> Column:
    """Struct (year, code, variant) of an archive's file name, null if it isn't one: code, month, then a year of four
    digits or of two (up to 69: this century), then the variant."""
    base = F.element_at(F.split(c, "/"), -1)
    code = F.when(F.lower(base).endswith(".7z"), F.substring(base, F.lit(1), F.length(base) - 3))

    def parse(s: Column) -> Column:
        month = F.substring(s, 4, 2).try_cast("int")
        four, two = F.substring(s, 6, 4), F.substring(s, 6, 2)
        long_ = four.rlike("^[0-9]{4}$")
        short = two.try_cast("int")
        year = F.when(long_, four.try_cast("int")).otherwise(F.when(short <= 69, 2000 + short).otherwise(1900 + short))
        rest = F.when(long_, F.substring(s, F.lit(10), F.length(s))).otherwise(F.substring(s, F.lit(8), F.length(s)))
        variant = F.when(rest != "", rest).otherwise(F.when(long_, F.lit("CD")).otherwise(F.lit("Standard")))
        ok = s.rlike("^CBS[0-9]{2}[0-9]{2}") & (month >= 1) & (month <= 12)
        return F.when(ok, F.struct(year.cast("int").alias("year"), s.alias("code"), variant.alias("variant")))

    return let(code, parse)


def wiki_url(language: Column | str, title: Column) -> Column:
    """Address of a page: blanks as underlines, all but letters, digits, _.-~ and / in percent form."""
    quoted = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for a, b in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        quoted = F.replace(quoted, F.lit(a), F.lit(b))
    return F.concat(F.lit("https://"), F.lit(language) if isinstance(language, str) else language, F.lit(".wikipedia.org/wiki/"), quoted)


def public_reason(c: Column) -> Column:
    """A failure as it may be published: rate limits and failed lookups by a word, other notes as they are."""
    t, low = F.trim(safe(c)), F.lower(F.trim(safe(c)))
    limited = low.contains("http error 429") | low.contains("too many requests")
    failed = low.startswith("request failed for http") | low.contains("urlopen error") | low.contains("timed out")
    return F.when(limited, F.lit("reference_lookup_rate_limited")).when(failed, F.lit("reference_lookup_failed")).otherwise(t)


def joined(values: Column, glue: str = "; ") -> Column:
    """Different non-blank texts of an array, trimmed, in order."""
    return F.array_join(F.array_distinct(F.filter(F.transform(values, lambda x: F.trim(safe(x))), lambda x: x != "")), glue)


def public_notes(values: Column) -> Column:
    """Notes of an array, each split at semicolons and fit to publish, joined."""
    return joined(F.transform(F.flatten(F.transform(values, lambda x: F.split(safe(x), ";"))), public_reason))


def lenient_int(c: Column) -> Column:
    """The number that a text is, truncated; null for any other text."""
    return F.trim(c).try_cast("double").try_cast("int")


def variant_fold(c: Column) -> Column:
    """Umlauts and sharp s as two letters, lower case, letters and digits only."""
    c = F.lower(F.coalesce(c, F.lit("")))
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(c, "[^a-z0-9]+", "")


def list_value(json: Column) -> Column:
    """A JSON text that is one value or a list: the non-blank texts in it."""
    as_list = F.from_json(json, "array<string>")
    one = F.array(F.btrim(json, F.lit('"')))
    return F.filter(F.transform(F.coalesce(as_list, one), lambda x: F.trim(x)), lambda x: x != "")
