"""Clinical text functions, all JVM-side expressions over whole texts."""

from __future__ import annotations

import re
import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlens import constants as C

_MARK = "\u0001"  # fences a found abbreviation; anything left of it is stripped with the other symbols
# listed one by one: Java looks such a class up in a table, a range it compares; the same text takes a sixth of the time
_KEPT = string.ascii_lowercase + string.digits + r".,\-/"


def clean_text(text: Column, abbreviations: Mapping[str, str] = C.ABBREVIATIONS) -> Column:
    """Lower-case, expand whole-word abbreviations, drop symbols, collapse blanks.

    One regular expression fences every abbreviation and a lookup expands the fenced pieces, so a text is
    scanned twice instead of once per abbreviation.  A null text becomes "".
    """
    words = "|".join(re.escape(a) for a in abbreviations)
    # most places fail at the first letter, before the word boundary is looked for
    firsts = "".join(sorted({re.escape(a[0]) for a in abbreviations}))
    fenced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), rf"(?U)(?=[{firsts}])\b({words})\b", f"{_MARK}$1{_MARK}")
    full = F.create_map(*[F.lit(word) for pair in abbreviations.items() for word in pair])
    # no other piece can equal an abbreviation: standing alone it would have been fenced itself
    pieces = F.transform(F.split(fenced, _MARK), lambda piece: F.coalesce(F.try_element_at(full, piece), piece))
    # runs of symbols and blanks become one blank; a single blank is left as it is
    symbols = rf" [^{_KEPT}]++|[^{_KEPT} ][^{_KEPT}]*+"
    return F.trim(F.regexp_replace(F.array_join(pieces, ""), symbols, " "))


def tokens(text: Column, first: int | None = None) -> Column:
    """Words between blanks; punctuation stays attached, empty text has no words.

    ``first`` wants only so many leading words: splitting then stops behind them.
    """
    # room for an empty piece before a leading blank and for the unsplit rest
    limit = -1 if first is None else first + 2
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+", limit), lambda w: w != "")
    return words if first is None else F.slice(words, 1, first)


def keyword_diagnosis(cleaned: Column) -> Column:
    """Struct (code, confidence) of the first keyword rule that matches."""
    chain = None
    for word, code, confidence in C.DIAGNOSIS_RULES:
        value = F.struct(F.lit(code).alias("code"), F.lit(confidence).alias("confidence"))
        hit = cleaned.contains(word)
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    code, confidence = C.DEFAULT_DIAGNOSIS
    return chain.otherwise(F.struct(F.lit(code).alias("code"), F.lit(confidence).alias("confidence")))


def _balance(positive: Column, negative: Column) -> Column:
    return (
        F.when(positive > negative, F.lit("POSITIVE"))
        .when(negative > positive, F.lit("NEGATIVE"))
        .otherwise(F.lit("NEUTRAL"))
    )


def _words_present(words: Column, listed: Sequence[str]) -> Column:
    return F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in listed])))


def _parts_present(text: Column, listed: Sequence[str]) -> Column:
    total = F.lit(0)
    for part in listed:
        total = total + F.coalesce(text.contains(part).cast("int"), F.lit(0))
    return total


def keyword_sentiment(text: Column, match: str = "token") -> Column:
    """Majority of listed words, each counted once: as whole tokens or anywhere in the text."""
    lowered = F.lower(text)
    if match == "token":
        words = tokens(lowered)
        return _balance(_words_present(words, C.TOKEN_POSITIVE), _words_present(words, C.TOKEN_NEGATIVE))
    if match == "substring":
        return _balance(
            _parts_present(lowered, C.SUBSTRING_POSITIVE), _parts_present(lowered, C.SUBSTRING_NEGATIVE)
        )
    raise ValueError(f"match is 'token' or 'substring', not {match!r}")


def plan_explanation(age: Column, chronic: Column, plan: Column) -> Column:
    return F.format_string(
        "Based on your profile (age %d, %d chronic conditions), "
        "the %s plan offers the best balance of coverage and cost.",
        age,
        chronic,
        F.coalesce(plan, F.lit(C.DEFAULT_PLAN)),
    )
