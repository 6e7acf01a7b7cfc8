"""Text functions with one meaning on every engine: trimming, folding, positions, bigrams, rounding."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: white space a script language would trim; Spark's own trim() knows the space only
SPACE = r"[\s\u00A0\uFEFF\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
#: letters that canonical decomposition takes apart into a plain letter and marks, and those letters in lower case
_APART = {chr(c): d[0].lower() for c in range(0x80, 0x2200) if (d := unicodedata.normalize("NFD", chr(c)))[0].isascii() and d[0].isalpha()}
ACCENTED, PLAIN = "".join(_APART), "".join(_APART.values())


def trim_all(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def normalise_key(c: Column) -> Column:
    """Lower case, without accents, be they part of a letter or marks of their own; other characters as single spaces:
    the form in which names are compared."""
    bare = F.lower(F.regexp_replace(F.translate(c, ACCENTED, PLAIN), r"\p{M}+", ""))
    return F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, where value is worked out once: inside a higher-order function it would be again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(numbers: Column, zero: int, add: Callable[[Column, Column], Column]) -> Column:
    """For each element what add makes of those before it. Blocks of about the square root of all keep the work of the
    growing arrays far below the square of their length."""
    none, begin = F.array().cast("array<bigint>"), F.lit(zero).cast("bigint")

    def grown(a: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), none.alias("got"))
        return F.aggregate(a, start, lambda s, n: F.struct(add(s["at"], n).alias("at"), F.concat(s["got"], F.array(s["at"])).alias("got")))["got"]

    def blocked(a: Column) -> Column:
        k = F.ceil(F.sqrt(F.size(a))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(a) / k).cast("int") - 1), lambda b: F.slice(a, b * k + 1, k))
        return let(blocks, lambda x: F.flatten(F.zip_with(x, grown(F.transform(x, lambda y: F.aggregate(y, begin, add)), begin), grown)))

    return let(F.transform(numbers, lambda n: n.cast("bigint")), lambda a: F.when(F.size(a) > 0, blocked(a)).otherwise(none))


def running_sums(numbers: Column) -> Column:
    """For each element the sum of those before it."""
    return _running(numbers, 0, lambda s, n: s + n)


def running_most(numbers: Column) -> Column:
    """For each element the largest of those before it, 0 at least."""
    return _running(numbers, 0, lambda s, n: F.greatest(s, n))


def running_least(numbers: Column, most: int = 1 << 40) -> Column:
    """For each element the smallest of those after it, ``most`` at most."""
    return F.reverse(_running(F.reverse(numbers), most, lambda s, n: F.least(s, n)))


def pieces(text: Column, pattern: str, mark: str = "\x03") -> Column:
    """The text cut at all leftmost non-overlapping matches: what stands before, a match, what stands between, and so on;
    matches are at odd places. The text must not contain the mark."""
    return F.split(F.regexp_replace(text, pattern, f"{mark}$0{mark}"), mark, -1)


def bigrams(c: Column) -> Column:
    """All two-character pieces, in order; none for fewer than two characters."""
    return F.when(F.length(c) >= 2, F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))


def dice(a: Column, b: Column) -> Column:
    """Dice coefficient of the two bigram multisets; 1 for equal strings, 0 where either is shorter than two."""
    x, y = bigrams(a), bigrams(b)
    shared = F.aggregate(F.array_distinct(x), F.lit(0), lambda s, g: s + F.least(F.size(F.filter(x, lambda e: e == g)), F.size(F.filter(y, lambda e: e == g))))
    return F.when(a == b, 1.0).when((F.length(a) < 2) | (F.length(b) < 2), 0.0).otherwise(2.0 * shared / (F.size(x) + F.size(y)))


def match_starts(text: Column, pattern: str) -> Column:
    """Starts (code points from 0) of all leftmost non-overlapping matches."""
    own = F.replace(text, F.lit("\x01"), F.lit(" "))
    parts = F.transform(F.split(F.regexp_replace(own, pattern, "\x01$0"), "\x01"), F.length)
    starts = let(running_sums(parts), lambda at: F.slice(at, 2, F.size(at)).cast("array<int>"))
    return F.when(F.rlike(text, F.lit(pattern)), starts).otherwise(F.array().cast("array<int>"))


def marker_positions(text: Column, markers: tuple[str, ...]) -> Column:
    """Distinct starts of all markers, ascending."""
    return F.array_sort(F.array_distinct(F.flatten(F.array(*[match_starts(text, m) for m in markers]))))


def first_marker(text: Column, markers: tuple[str, ...]) -> Column:
    """The first start of any marker, or null."""
    return F.array_min(F.array(*[F.nullif(F.regexp_instr(text, F.lit(m)), F.lit(0)) - 1 for m in markers]))


def rounded_percent(part: Column, whole: Column) -> Column:
    """part of whole in percent with one decimal, half up; null where whole is 0."""
    return F.floor(F.try_divide(part, whole) * 1000 + 0.5) / 10


def column_letter(i: Column) -> Column:
    """Spreadsheet letters of a 1-based column number, up to three."""
    def chars(n: Column) -> Column:
        return F.char(65 + n)

    one, two = i - 1, i - 27
    three = i - 703
    return F.when(i < 1, "").when(i <= 26, chars(one % 26)).when(i <= 702, F.concat(chars(F.floor(two / 26).cast("int")), chars(two % 26))).otherwise(F.concat(chars(F.floor(three / 676).cast("int")), chars(F.floor(three / 26).cast("int") % 26), chars(three % 26)))
