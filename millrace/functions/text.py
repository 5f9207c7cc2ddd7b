"""Column helpers with Python `str` semantics, all built-in expressions (no Python at run time).

Lengths and slices are in code points; blanks, digits and letters are those of Unicode. Null input gives null
unless a helper says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What Python's str.strip() and \s take as blank, and what splitlines() takes as a line end.
BLANK = r"\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BLANK_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
LINE_END = r"\n\r\x{0b}\x{0c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}"
CUT_MARK = "\n...[中间截断]...\n"


def bind(value: Column, f) -> Column:
    """f(value) with value computed once: a column that f uses often would otherwise be computed at each use."""
    return F.element_at(F.transform(F.array(value), f), 1)


def strip_u(c: Column) -> Column:
    """str.strip()."""
    return F.btrim(c, F.lit(BLANK_CHARS))


def rstrip_u(c: Column) -> Column:
    return F.rtrim(c, F.lit(BLANK_CHARS))


def nonblank(c: Column) -> Column:
    return F.length(strip_u(c)) > 0


def first_text(*cols: Column) -> Column:
    """The first column that isn't null or empty, then stripped; '' if there is none. A blank first column wins and gives ''."""
    return strip_u(F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit("")))


def _without_last_blank(pieces: Column) -> Column:
    """Pieces between line ends as lines: no empty one after the last line end."""
    return bind(pieces, lambda p: F.slice(p, 1, F.size(p) - (F.element_at(p, -1) == "").cast("int")))


# Both look for line ends only: a pattern for the text between them is several times slower.
def raw_lines(c: Column) -> Column:
    """Lines with their line ends, as splitlines(True)."""
    return _without_last_blank(F.split(c, rf"(?<=[{LINE_END}])(?!(?<=\r)\n)"))


def split_lines(c: Column) -> Column:
    """splitlines(): without line ends, and without an empty piece after the last one."""
    return _without_last_blank(F.split(c, rf"\r\n|[{LINE_END}]"))


def stripped_lines(c: Column) -> Column:
    """Lines that aren't blank, stripped."""
    return F.filter(F.transform(split_lines(c), strip_u), lambda x: F.length(x) > 0)


def sentences(c: Column) -> Column:
    """Pieces between the sentence marks 。？！；;!? and line feeds, stripped, blanks dropped."""
    return F.filter(F.transform(F.split(c, r"[。？！；;!?\n\r]"), strip_u), lambda x: F.length(x) > 0)


def compact_key(c: Column) -> Column:
    """Match key: lower case, letters and numbers only."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", "")


def trigram_support(answer: Column, source: Column) -> Column:
    """Share of the answer's character trigrams (with repetition) that the source holds, both as match keys.

    0.0 where the answer's key has under three characters or the source's is empty; null counts as empty."""

    def support(k: Column) -> Column:
        n = F.length(k["a"]) - 2
        hits = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda acc, i: acc + F.when(F.contains(k["s"], F.substring(k["a"], i, F.lit(3))), 1).otherwise(0))
        return F.when((n < 1) | (F.length(k["s"]) == 0), F.lit(0.0)).otherwise(hits / n)

    return bind(F.struct(compact_key(answer).alias("a"), compact_key(source).alias("s")), support)


def clip(c: Column, limit: int) -> Column:
    """Head and tail around a mark where the text is longer than limit."""
    half = limit // 2
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(half)), F.lit(CUT_MARK), F.right(c, F.lit(half)))).otherwise(c)


def snippet(c: Column, limit: int = 220) -> Column:
    """One line: runs of blanks become one, cut at limit with '...'."""
    one = strip_u(F.regexp_replace(F.coalesce(c, F.lit("")), rf"[{BLANK}]+", " "))
    return F.when(F.length(one) <= limit, one).otherwise(F.concat(rstrip_u(F.left(one, F.lit(limit))), F.lit("...")))


def is_zh(c: Column) -> Column:
    """Holds an ideograph U+4E00 to U+9FFF."""
    return F.coalesce(c, F.lit("")).rlike(r"[\x{4e00}-\x{9fff}]")


def fill_template(template: Column, values: list[tuple[str, Column]]) -> Column:
    """Literal replacement of {name} in the given order; a value that holds a later {name} is filled too."""
    for name, v in values:
        template = F.replace(template, F.lit("{" + name + "}"), v)
    return template


def count_of(c: Column, pattern: str) -> Column:
    """Number of non-overlapping matches, 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(pattern)), F.lit(0))


def share_of(lines: Column, test) -> Column:
    """Share of the lines for which test(line) holds; 0 for no lines. `lines` should be a plain or bound column."""
    return F.when(F.size(lines) > 0, F.size(F.filter(lines, test)) / F.size(lines)).otherwise(F.lit(0.0))


def positional_percentile(values: Column, p: float) -> Column:
    """The element at int(p * (n - 1)) of the sorted values of a group, 0 for none (no interpolation)."""
    s = F.array_sort(F.collect_list(values))
    n = F.size(s)
    return F.when(n > 0, F.try_element_at(s, F.floor(F.lit(p) * (n - 1)).cast("int") + 1)).otherwise(F.lit(0))
