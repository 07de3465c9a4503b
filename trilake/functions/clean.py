"""Typing of untyped raw text.

Every rule is a Column -> Column function; ``typed`` gathers a table's rules. A rule that
looks at a value and then returns it would compute that value for each mention, so ``typed``
applies such rules step by step, one projection for each step. Names that a raw file lacks
are skipped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The null-like text literals (case-sensitive, after trimming spaces).
NULL_LIKE = ("", "null", "NULL", "None", "nan", "NaN", "N/A", "n/a")

# Accepted boolean spellings (lower-cased and trimmed).
BOOLEAN_TEXT = {"true": True, "1": True, "yes": True, "false": False, "0": False, "no": False}

# Number text that a non-ANSI cast to a whole number takes: optional sign, digits with an
# optional point, or a leading point. Exponents are rejected.
NUMBER_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
# The same, with its sign and the digits before the point.
WHOLE_PART = r"^(?<sign>[+-]?)(?:(?<digits>[0-9]+)[.]?[0-9]*|[.][0-9]+)$"
# That cast ignores every leading or trailing character up to 0x20, not only spaces.
EDGE_CONTROL = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _bare(c: Column) -> Column:
    return F.trim(c.cast("string"))


def _not_null_like(c: Column) -> Column:
    return F.when(~c.isin(*NULL_LIKE), c)


def known_text(c: Column) -> Column:
    """Trimmed text; null-like literals become null."""
    return _not_null_like(_bare(c))


def whole(c: Column, kind: str = "int") -> Column:
    """Text to a whole number: truncated, null for junk or what does not fit.

    Plain digits take the direct cast; only other text (``1995.0``) meets the pattern, and is
    cast without its fraction. One mention of each step: the code that Spark makes of a wide
    table's rules must stay below the size up to which the JVM compiles a method (8000 bytes)."""
    text = c.cast("string")
    # what is no number stays as it is, and the cast refuses it
    digits = F.regexp_replace(F.regexp_replace(text, EDGE_CONTROL, ""), WHOLE_PART, "${sign}0${digits}")
    return F.coalesce(text.try_cast(kind), digits.try_cast(kind))


def identifier(c: Column) -> Column:
    """F1/M4: ids are 64 bits wide; a narrower type would lose rows without a word."""
    return whole(c, "bigint")


def real(c: Column) -> Column:
    """Text to double; junk and NaN (B6) become null."""
    return F.nanvl(F.trim(c.cast("string")).try_cast("double"), F.lit(None).cast("double"))


def truth(c: Column) -> Column:
    """The accepted spellings, else null."""
    spelled = F.create_map(*[F.lit(x) for pair in BOOLEAN_TEXT.items() for x in pair])
    return F.try_element_at(spelled, F.lower(F.trim(c.cast("string"))))


def _spaced(c: Column) -> Column:
    return F.regexp_replace(c, r"\s*,\s*", ", ")


def _without_empty(c: Column) -> Column:
    # after _spaced, two commas with nothing between them are always ", ,"
    return F.when(F.contains(c, F.lit(", ,")), F.regexp_replace(c, r",\s*,", ", ")).otherwise(c)


def token_list(c: Column) -> Column:
    """P5: lower-cased comma list with ``, `` between tokens; one pass over empty tokens."""
    return _not_null_like(_without_empty(_spaced(F.lower(F.trim(c)))))


def not_negative(c: Column) -> Column:
    """Negatives become null, zero stays."""
    return F.when(c >= 0, c)


def within(c: Column, low: float, high: float) -> Column:
    """Values outside [low, high] become null, the row stays."""
    return F.when(c.between(low, high), c)


def code(c: Column) -> Column:
    """Trimmed upper-case code."""
    return F.upper(F.trim(c))


def three_way(c: Column, high: float = 300, medium: float = 100) -> Column:
    """Above ``high``, above ``medium``, or low (null is low)."""
    return F.when(c > high, "high").when(c > medium, "medium").otherwise("low")


def valid_id(key: str = "tmdb_id") -> Column:
    """the id is known and positive."""
    return F.coalesce(F.col(key) > 0, F.lit(False))


def has_text(key: str) -> Column:
    """the text key is known and not empty."""
    return F.coalesce(F.length(key) > 0, F.lit(False))


def typed(df: DataFrame, *, text=(), ids=(), ints=(), doubles=(), bools=(), lists=()) -> DataFrame:
    """P1-P5 over the scan, a projection for each step. A name may be in ``text`` and in one of
    the others; the text rule applies first."""
    rules: dict[str, list[Callable[[Column], Column]]] = {}
    for names, steps in ((text, (_bare, _not_null_like)), (ids, (identifier,)), (ints, (whole,)), (doubles, (real,)), (bools, (truth,)),
                         (lists, (lambda c: _spaced(F.lower(F.trim(c))), _without_empty, _not_null_like))):
        for name in set(names) & set(df.columns):
            rules.setdefault(name, []).extend(steps)
    for i in range(max(map(len, rules.values()), default=0)):
        df = df.withColumns({name: steps[i](F.col(name)) for name, steps in rules.items() if i < len(steps)})
    return df
