"""Folding letters to ASCII: sharp s as two letters, compatibility forms decomposed, combining marks dropped. Native."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that texts of Latin letters are made of; a text of others takes the longer way.
LATIN = [(0, 0x250), (0x300, 0x370), (0x1E00, 0x1F00), (0x2010, 0x2016), (0x2018, 0x2020)]
#: The Korean syllables, whose parts follow from their number (fixed values of the standard).
KOREAN, LEAD, VOWEL, TAIL = 0xAC00, 0x1100, 0x1161, 0x11A7
VOWELS, TAILS, SYLLABLES = 21, 28, 11172
PART = "\x01"


def folded(text: str) -> str:
    text = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("ẞ", "SS"))
    return "".join(c for c in text if not unicodedata.combining(c))


def char_class(codes: list[int], negated: bool = False) -> str:
    """A pattern for one of these characters, given in order, as few ranges."""
    runs: list[list[int]] = []
    for i in codes:
        if runs and i == runs[-1][1] + 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return f"[{'^' * negated}" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" if a < b else f"\\x{{{a:X}}}" for a, b in runs) + "]"


@lru_cache(1)
def rule() -> dict[str, str]:
    """Every character that doesn't fold to itself, surrogates and Korean syllables left out."""
    codes = (i for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000 and not KOREAN <= i < KOREAN + SYLLABLES)
    return {c: f for c in map(chr, codes) if (f := folded(c)) != c}


@lru_cache(1)
def latin() -> tuple[str, str, str]:
    """Of the Latin blocks: the characters that fold to one other, what they fold to, and a pattern of the texts that
    these and the dropping of marks fold rightly (runs of ASCII are passed at once)."""
    some = [chr(i) for a, b in LATIN for i in range(a, b)]
    one = [c for c in some if len(rule().get(c, "")) == 1]
    simple = [ord(c) for c in some if c not in rule() or c in one or c in "ßẞ" or 0x300 <= ord(c) < 0x370]
    return "".join(one), "".join(rule()[c] for c in one), rf"^(?:[\x00-\x7F]++|{char_class(simple)})*+\z"


@lru_cache(1)
def others() -> tuple[str, str, str, str, str]:
    """Of all characters: those that fold to one other and what they fold to; a class of those that fold to several and a
    text with the several behind each; a class of those that are dropped."""
    one = [c for c, f in rule().items() if len(f) == 1]
    more = [c for c, f in rule().items() if len(f) > 1]
    none = [ord(c) for c, f in rule().items() if not f]
    return "".join(one), "".join(rule()[c] for c in one), char_class(list(map(ord, more))), PART + PART.join(c + rule()[c] for c in more) + PART, char_class(none)


def any_script(c: Column) -> Column:
    """The fold of a text of any script. Only characters that become several are looked up one by one."""
    from_, to, several, table, dropped = others()

    def look_up(ch: Column) -> Column:
        return F.substring_index(F.substring(F.lit(table), F.instr(F.lit(table), F.concat(F.lit(PART), ch)) + 2, F.lit(40)), PART, 1)

    def korean(ch: Column) -> Column:
        n = F.ascii(ch) - KOREAN
        hexed = lambda x: F.lpad(F.hex(x), 4, "0")
        lead, vowel, tail = F.floor(n / (VOWELS * TAILS)), F.floor(n % (VOWELS * TAILS) / TAILS), n % TAILS
        return F.decode(F.unhex(F.concat(hexed(lead + LEAD), hexed(vowel + VOWEL), F.when(tail > 0, hexed(tail + TAIL)).otherwise(""))), "UTF-16BE")

    def one(ch: Column) -> Column:
        return F.when(ch.rlike(several), look_up(ch)).when(ch.between(chr(KOREAN), chr(KOREAN + SYLLABLES - 1)), korean(ch)).otherwise(ch)

    return F.regexp_replace(F.array_join(F.transform(F.split(F.translate(c, from_, to), ""), one), ""), dropped, "")


def ascii_fold(c: Column) -> Column:
    """The folded text; null is the empty text."""
    c = F.coalesce(c, F.lit(""))
    from_, to, all_simple = latin()
    plain = F.translate(F.replace(F.replace(c, F.lit("ß"), F.lit("ss")), F.lit("ẞ"), F.lit("SS")), from_, to)
    ascii_ = F.octet_length(c) == F.length(c)
    return F.when(ascii_, c).when(~c.rlike(all_simple), any_script(c)).otherwise(F.regexp_replace(plain, "[\\u0300-\\u036F]+", ""))
