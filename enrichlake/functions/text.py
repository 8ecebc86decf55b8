"""Text helpers whose rules follow Python's `re` and `str`, run on the JVM.

Java and Python regular expressions differ in three ways that change results:

* `\\w`, `\\b`, `\\s`, `\\d` are ASCII in Java unless `(?U)` is on;
* case folding is ASCII in Java unless `(?u)` is on;
* `.`, `^` and `$` know more line ends in Java unless `(?d)` is on.

Every pattern of the library therefore goes through :func:`rx`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed by a Unicode-aware strip.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 "
    "           "
    "    　"
)
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
BLANK_LINE = r"(?U)\n\s*\n"


def rx(pattern: str, ignore_case: bool = False, multiline: bool = False, dotall: bool = False) -> str:
    """Prefix a pattern with the flags that give it Python semantics."""
    flags = "dU" + ("iu" if ignore_case else "") + ("m" if multiline else "") + ("s" if dotall else "")
    return f"(?{flags}){pattern}"


# (plain texts of which every match holds one, characters a match starts with, pattern)
Wording = tuple[tuple[str, ...], str, str]


def holds_any(low: Column, texts: tuple[str, ...]) -> Column:
    out = F.contains(low, F.lit(texts[0]))
    for text in texts[1:]:
        out = out | F.contains(low, F.lit(text))
    return out


def says(low: Column, wording: Wording) -> Column:
    """TRUE when lower-cased text matches the wording.

    Every match holds one of a few plain texts. Looking for those first costs a
    tenth of a regular expression and settles most pages.
    """
    texts, first, pattern = wording
    return holds_any(low, texts) & matches(low, ahead(first, pattern))


def count_says(low: Column, wording: Wording) -> Column:
    texts, first, pattern = wording
    return F.when(holds_any(low, texts), count_matches(low, ahead(first, pattern))).otherwise(0)


def ahead(first: str, pattern: str) -> str:
    """A pattern whose matches start with one of the `first` characters, anywhere."""
    return rx(rf"(?=[{first}])(?:{pattern})")


def literal(phrase: str) -> str:
    """Escape a phrase for a regular expression; a space stands for any whitespace run."""
    out = []
    for ch in phrase:
        if ch == " ":
            out.append(r"\s+")
        elif ch.isalnum() or ch in "_-/'":
            out.append(ch)
        else:
            out.append("\\" + ch)
    return "".join(out)


def _quoted(value: str | None) -> str:
    if value is None:
        return "null"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(values) -> Column:
    """Literal ARRAY<STRING>, built in one call however long it is."""
    return F.expr("array(" + ", ".join(_quoted(v) for v in values) + ")")


def text_map(pairs) -> Column:
    """Literal MAP<STRING, STRING> of (key, value) pairs."""
    return F.expr("map(" + ", ".join(f"{_quoted(k)}, cast({_quoted(v)} as string)" for k, v in pairs) + ")")


def strip(c: Column, extra: str = "") -> Column:
    return F.btrim(c, F.lit(WHITESPACE + extra))


def blank_to_null(c: Column) -> Column:
    """NULL for ''. `nullif` would evaluate an expensive `c` twice."""
    return let(c, lambda v: F.when(v != "", v))


def is_blank(c: Column) -> Column:
    """NULL or the empty string."""
    return c.isNull() | (c == "")


def extract(c: Column, pattern: str, group: int = 0) -> Column:
    """`regexp_extract` that gives NULL, not '', when nothing matches."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def extract_all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def matches(c: Column, pattern: str) -> Column:
    return F.rlike(c, F.lit(pattern))


def count_matches(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def lines(c: Column) -> Column:
    return F.split(c, LINE_BREAK)


def paragraphs(c: Column) -> Column:
    return F.split(c, BLANK_LINE)


def tokens(c: Column) -> Column:
    """Whitespace-separated tokens without empty ones."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda t: t != "")


def word_count(c: Column) -> Column:
    """Number of runs of ASCII letters and apostrophes."""
    return count_matches(c, "[A-Za-z']+")


def has_words(c: Column, n: int) -> Column:
    """TRUE when the text has at least `n` such runs; stops reading at the n-th."""
    return matches(c, rf"\A[^A-Za-z']*+(?:[A-Za-z']++[^A-Za-z']++){{{n - 1}}}[A-Za-z']")


def evaluated(c: Column) -> Column:
    """The same value, behind a mark the optimizer does not move filters across.

    A filter on a computed column is otherwise pushed below the projection, which
    copies the whole extraction into the filter and runs it twice. The mark is a
    task attribute that counts as non-deterministic and costs nothing.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def slug(c: Column, sep: str) -> Column:
    """Lower-case, every run of other characters becomes `sep`, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", sep), F.lit(sep))


def first_or_null(arr: Column) -> Column:
    return F.get(arr, F.lit(0))


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body`, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def keep_first_by(arr: Column, key) -> Column:
    """Drop array elements whose key was already seen, keeping text order."""

    def keep(xs: Column) -> Column:
        return let(
            F.transform(xs, key),
            lambda keys: F.filter(xs, lambda x, i: F.array_position(keys, key(x)) == i + 1),
        )

    return let(arr, keep)
