"""Text normal forms and matches with code-point offsets, as Column expressions.

Spark has no "find all with offsets". Matches are wrapped in two marker characters by one regexp_replace and the text
is split at the first marker, so a piece's length gives the next offset; all of it stays in the JVM."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN, CLOSE = "\u0001", "\u0002"

# Vietnamese letters and the ASCII letters under them, lower case.
_FOLD_FROM = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
_FOLD_TO = "aaaaaaaaaaaaaaaaaeeeeeeeeeeeiiiiiooooooooooooooooouuuuuuuuuuuyyyyyd"


@cache
def _class(kind: str) -> str:
    """A character class by rule: `plain`, the Latin letters, digits and marks that NFKC leaves as they are wherever they
    stand; `marks`, all combining marks."""
    if kind == "plain":
        points = [c for c in (*range(0x250), *range(0x1E00, 0x1F00), *range(0x2010, 0x2028)) if not unicodedata.combining(chr(c)) and unicodedata.is_normalized("NFKC", chr(c))]
    else:
        points = [c for c in range(0x110000) if unicodedata.combining(chr(c))]
    runs: list[list[int]] = []
    for c in points:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs)


def _icu(method: str, c: Column) -> Column:
    """A form of compatibility by the ICU library that Spark brings, inside the JVM."""
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit(method), F.coalesce(c, F.lit("")), F.lit(True))


def nfkc(c: Column) -> Column:
    """NFKC; text of plain characters alone, which most is, is only looked through."""
    return F.when(c.rlike(f"[^{_class('plain')}]"), _icu("compose", c)).otherwise(c)


def strip_marks(c: Column) -> Column:
    """NFKD, combining marks dropped, NFKC; ASCII is only looked through."""
    bare = F.regexp_replace(_icu("decompose", c), f"[{_class('marks')}]", "")
    return F.when(c.rlike(r"[^\x00-\x7F]"), nfkc(bare)).otherwise(c)


def let(value: Column, use) -> Column:
    """use(value) with the value computed once, however often and wherever `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def squeeze(c: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def norm(c: Column) -> Column:
    """The matching form: NFKC, lower case, quotes, brackets and list marks to spaces."""
    return squeeze(F.translate(F.lower(nfkc(c)), "“”\"'`,:;()[]{}", " " * 14))


def folded(c: Column) -> Column:
    """norm without accents."""
    return unaccented(norm(c))


def unaccented(n: Column) -> Column:
    """folded, of what norm gave. The letters of Vietnamese and Latin-1 by a table; what isn't ASCII then, by
    decomposition."""
    return squeeze(strip_marks(F.translate(n, _FOLD_FROM + "äëïöüçñåûî", _FOLD_TO + "aeioucnaui")))


def filter_key(c: Column) -> Column:
    """Lower case, without blanks, colons and hyphens at the ends, white space squeezed."""
    return squeeze(F.btrim(F.lower(c), F.lit(" :-")))


def hits(text: Column, pattern: str, groups: str = "$0") -> Column:
    """array<struct<start,end>> of what `groups` wraps in each leftmost non-overlapping match. `groups` is the
    replacement of a match; the wanted part stands between OPEN and CLOSE, by default the whole match."""
    repl = f"{OPEN}$0{CLOSE}" if groups == "$0" else groups
    pieces = F.split(F.regexp_replace(F.translate(text, OPEN + CLOSE, "  "), pattern, repl), OPEN, -1)
    return _walk(pieces)


def _walk(pieces: Column) -> Column:
    """Offsets from the pieces between markers: a piece behind an OPEN holds one CLOSE, which takes no place."""
    first = F.struct(F.length(F.element_at(pieces, 1)).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc, p):
        n = F.instr(p, CLOSE) - 1
        return F.struct((acc["at"] + F.length(p) - 1).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), (acc["at"] + n).alias("end")))).alias("out"))

    return F.aggregate(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), first, step, lambda acc: acc["out"])


def pieces(text: Column, pattern: str) -> Column:
    """The text cut at both ends of each match: what lies before, match, gap, match, ..., gap."""
    return F.split(F.regexp_replace(F.translate(text, OPEN + CLOSE, "  "), pattern, f"{OPEN}$0{CLOSE}"), f"[{OPEN}{CLOSE}]", -1)


def offsets(parts: Column, block: int = 256) -> Column:
    """Where each string of an array begins in their concatenation, and its length at the end. Sums go by the block, so
    that long arrays are not copied for each of their strings."""
    running = lambda lengths, first: F.aggregate(lengths, F.array(first), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    total = lambda lengths: F.aggregate(lengths, F.lit(0), lambda acc, n: acc + n)

    def by_block(lengths: Column) -> Column:
        cuts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(lengths), F.lit(1)) - 1) / block).cast("int"))
        return F.transform(cuts, lambda b: F.slice(lengths, b * block + 1, block))

    def summed(blocks: Column, begin: Column) -> Column:
        each = F.transform(blocks, lambda x, i: F.slice(running(x, F.get(begin, i)), 1, F.size(x)))
        return F.concat(F.flatten(each), F.array(F.element_at(begin, -1)))

    return let(F.transform(parts, lambda x: F.length(x)), lambda lengths: let(by_block(lengths), lambda blocks: let(running(F.transform(blocks, lambda x: total(x)), F.lit(0)), lambda begin: summed(blocks, begin))))


def cut(text: Column, start: Column, end: Column) -> Column:
    """text[start:end]."""
    return F.substring(text, start + 1, end - start)


def alternatives(terms: list[str]) -> str:
    """A regular expression of the terms, longest first."""
    return "|".join("".join("\\" + ch if not ch.isalnum() and ch != " " and ord(ch) < 128 else ch for ch in t) for t in sorted(set(terms), key=lambda t: (-len(t), t)))


def whole_word(terms: list[str]) -> str:
    return rf"(?iuU)(?<!\w)(?:{alternatives(terms)})(?!\w)"


_TRIM = r"""[ \t\r\n!"#$%&'()*+,./:;<=>?@\[\\\]^_`{|}~]*"""


def trim_span(text: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """The span without white space and ASCII marks other than the hyphen at its ends, clamped to the text."""
    s, e = F.greatest(start, F.lit(0)), F.least(end, F.length(text))
    body = F.substring(text, s + 1, F.greatest(e - s, F.lit(0)))
    lead = F.length(F.regexp_extract(body, "^" + _TRIM, 0))
    tail = F.length(F.regexp_extract(body, _TRIM + r"\z", 0))
    return s + lead, F.greatest(s + lead, e - tail)


# The units of a drug's strength.
STRENGTH_UNITS = "mg|mcg|µg|g|ml|iu|unit|units|%"
_NUMBER = r"\d+(?:[.,]\d+)?"


def strength_keys(c: Column) -> Column:
    """Ordered distinct '<value> <unit>' keys: both ends of ranges first, then single values."""
    ranged = rf"(?iu)(?<![\d.,])({_NUMBER})[ \t]*-[ \t]*({_NUMBER})[ \t]*({STRENGTH_UNITS})(?![A-Za-z])"
    single = rf"(?iu)(?<![\d.,])({_NUMBER})[ \t]*({STRENGTH_UNITS})(?![A-Za-z])"
    key = lambda v, u: F.concat(F.translate(v, ",", "."), F.lit(" "), F.lower(u))
    parts = lambda p, k: F.regexp_extract_all(c, F.lit(p), k)
    both = F.flatten(F.zip_with(F.zip_with(parts(ranged, 1), parts(ranged, 2), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), parts(ranged, 3), lambda ab, u: F.array(key(ab["a"], u), key(ab["b"], u))))
    one = F.zip_with(parts(single, 1), parts(single, 2), key)
    return F.array_distinct(F.concat(both, one))
