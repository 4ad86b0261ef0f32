"""Secret scans: patterns for well-known forms, and two character Markov models, of random strings and of ordinary
identifiers, compared by their log-likelihood ratio on every long run of identifier characters, and on the parts of a run that is
not random as a whole (a key behind a path or a name).

The models are trained from labelled samples that are made here from a fixed seed: random strings over the usual key
alphabets, and identifiers joined from common words in the usual spellings, with years, counters and versions. They
don't depend on the corpus, so a text is judged alike at every size.

Defined cases: a null text is an empty one (no spans, the digest of an empty string); a null doc_id stays null; repeated
rows are scanned each; of overlapping spans of different kinds all are reported, the model's only where no pattern
matched; an empty table gives no rows. Extra columns are ignored by scan_table and kept by redact. Texts are scanned
whole, runs and spans side by side; only a single run of very many alternating parts takes more than linear time."""

from __future__ import annotations

import hashlib
import math
import random
import re
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, only, small_batches, table

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: One of these is in every match of ASSIGN; a text without them needs no search.
KEYS = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Candidates of the model: runs with a letter (numbers, dates and rules of dashes are none). Without a digit, a part must
#: have so many different characters, as random letters have almost surely; "aaaaaaaaaaaaaaaa" hasn't.
LEAST_LETTERS = 8
RUN = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}")
#: Log-likelihood ratio per character from which a run counts as random.
LEAST_RATIO = 0.55
LEAST_CHARS, DROP = 16, 8.0
MASK = "[secret]"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_+/=-"
COMMON = """account action active address admin after agent alert apply archive area array article asset async author auto back
balance base batch begin block board body book border branch buffer build button cache call cancel card center change
channel chart check child circle class clean click client clock close cloud cluster code color column command comment
commit common compare config connect console contact content context control copy count create current cursor custom data
date debug default delete detail device dialog direct display document domain double download draw driver drop dump edit
email empty enable encode end engine entry error event example execute expire export extend factory fail fetch field file
filter final find finish first flag float flow folder font footer form format forward frame from full function gateway
general global graph grid group guide handle hash header height help hidden history home host html icon image import index
info inner input insert instance internal invoice item job join journal key label language large last layer layout length
level library light limit line link list load local lock login logic long loop machine mail main manager map mark master
match max member memory menu merge message method metric middle minute mobile mode model module monitor month mouse move
name native network next node normal note null number object offset open option order origin output owner package page
panel param parent parse part path pattern payment person phone pixel place plain player plugin point policy pool port post
power prefix press preview price primary print private process product profile project property protocol provider proxy
public query queue quick random range rate read ready record reference refresh region register release remote remove render
replace report request reset resource response result return role root round route row rule run sample save scale schema
scope screen script scroll search second section select send sequence server service session set setting share shift short
show side sign simple single site size skip small socket sort source space spec split stack start state static status step
stop storage store stream string style submit sum support switch symbol sync system table tag target task template test
text theme thread time title toggle tool total trace track transfer tree trigger type unique unit update upload url user
util valid value variable version vertical video view visible volume wait watch web week weight width window word work
wrapper write year zone""".split()


def samples(seed: int = 11, n: int = 6000) -> tuple[list[str], list[str]]:
    """Labelled strings: random ones, ordinary ones."""
    r = random.Random(seed)
    upper, lower, digit = ALPHABET[26:52], ALPHABET[:26], ALPHABET[52:62]
    sets = ["0123456789abcdef", upper + digit, lower + digit, upper + lower + digit, upper + lower + digit, upper + lower + digit + "+/", upper + lower + digit + "_-"]
    odd = ["".join(r.choice(a) for _ in range(r.randint(16, 64))) for a in (r.choice(sets) for _ in range(n))]

    def name() -> str:
        w = [r.choice(COMMON) for _ in range(r.randint(2, 6))]
        s = r.choice([lambda: "_".join(w), lambda: "-".join(w), lambda: "".join(x.title() for x in w), lambda: w[0] + "".join(x.title() for x in w[1:]), lambda: "_".join(w).upper(), lambda: "".join(w), lambda: "/".join(w)])()
        return s + r.choice(["", "", "", str(r.randint(1, 99)), f"_{r.randint(1990, 2030)}", f"-v{r.randint(1, 9)}", f"_{r.randint(1, 9999):04d}", f"-{r.randint(1990, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}"])

    return odd, [name() for _ in range(n)]


def transitions(strings: list[str]) -> np.ndarray:
    """Log probabilities of a character after another, by add-one counts; row -1 is the start."""
    at = {c: i for i, c in enumerate(ALPHABET)}
    n = np.ones((len(at) + 1, len(at)))
    for s in strings:
        last = -1
        for c in s:
            n[last, at[c]] += 1
            last = at[c]
    return np.log(n / n.sum(1, keepdims=True))


@lru_cache(1)
def ratios() -> dict[str, float]:
    """Pair of characters -> log-likelihood ratio of random to ordinary."""
    odd, plain = (transitions(x) for x in samples())
    d = odd - plain
    return {a + b: float(d[i, j]) for i, a in enumerate(ALPHABET) for j, b in enumerate(ALPHABET)}


def ratio(s: str) -> float:
    """Mean log-likelihood ratio per character: above zero, rather random."""
    r = ratios()
    return math.fsum(r[s[i : i + 2]] for i in range(len(s) - 1)) / max(1, len(s) - 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the patterns' matches."""
    out = []
    if KEYS.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def random_parts(s: str) -> list[tuple[int, int]]:
    """(start, end) of what counts as random in a run: all of it by its mean, or else its parts of LEAST_CHARS or more whose
    ratios exceed LEAST_RATIO by the largest sum, widened to whole words; a fall of DROP below that sum parts two of them."""
    if ratio(s) >= LEAST_RATIO:
        return [(0, len(s))]
    r = ratios()
    sums = [0.0, *accumulate(r[s[i : i + 2]] - LEAST_RATIO for i in range(len(s) - 1))]
    out, best, low, j = [], None, 0, LEAST_CHARS - 1
    while j < len(s):
        low = min(low, j - LEAST_CHARS + 1, key=sums.__getitem__)
        now = sums[j] - sums[low]
        if now >= 0 and (best is None or now > best[0]):
            best = now, low, j + 1
        elif best and best[0] - now > DROP:
            out.append(best[1:])
            low, j, best = best[2], best[2] + LEAST_CHARS - 2, None
        j += 1
    wide, at = [], 0
    for a, b in out + ([best[1:]] if best else []):
        if b > at:
            a = max(a, at)
            while a > at and (s[a - 1].isalnum() or s[a - 1] == "+"):
                a -= 1
            while b < len(s) and (s[b].isalnum() or s[b] in "+="):
                b += 1
            wide.append((a, b))
            at = b
    return wide


def varied(s: str) -> bool:
    """Whether a part has a letter, and a digit or at least LEAST_LETTERS different characters."""
    return any(c.isalpha() for c in s) and (any(c.isdigit() for c in s) or len(set(s)) >= LEAST_LETTERS)


def united(found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The places that sorted spans cover, as spans without overlap."""
    out: list[tuple[int, int]] = []
    for a, _, b in found:
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def model_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Random parts of the long runs; of a run that overlaps the patterns' spans, of what they leave. Runs and spans are
    both in order, so each is looked at once."""
    out, taken, k = [], united(base), 0
    for m in RUN.finditer(text):
        a, b = m.span()
        left = []
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        j = k
        while j < len(taken) and taken[j][0] < b:
            left.append((a, taken[j][0]))
            a = max(a, taken[j][1])
            j += 1
        for x, y in [*left, (a, b)]:
            s = text[x:y]
            if len(s) >= LEAST_CHARS and any(c.isalpha() for c in s):
                out += [(x + p, 3, x + q) for p, q in random_parts(s) if varied(s[p:q])]
    return out


def spans(text: str | None) -> tuple[list, list]:
    """The patterns' spans, and all spans, each by start, then kind."""
    base = base_spans(text or "")
    return base, sorted(base + model_spans(text or "", base))


def said(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan_table(docs: DataFrame) -> DataFrame:
    """doc_id, counts, digest of the patterns' spans and all spans, for every row of docs."""

    def work():
        def of(texts: list) -> dict:
            both = [spans(t) for t in texts]
            out = {f"n_{kind}": [sum(x == k for _, x, _ in base) for base, _ in both] for k, kind in enumerate(KINDS[:3])}
            return out | {"base_sha256": [hashlib.sha256(said(base).encode()).hexdigest() for base, _ in both], "spans": [said(found) for _, found in both]}

        return of

    return map_texts(docs, work, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def masked(text: str | None) -> str | None:
    """The text with every span's characters replaced by one mask (overlapping spans share it)."""
    if text is None:
        return None
    out, at = [], 0
    for a, _, b in spans(text)[1]:
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows of docs with their secrets masked and n_chars, where there is one, set to the new length."""

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        only(None)
        return texts.map(masked, na_action="ignore")

    small_batches(spark)
    out = docs.withColumn("text", mask(docs["text"].cast("string")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan_table(table(spark, sf_dir, "documents"))
