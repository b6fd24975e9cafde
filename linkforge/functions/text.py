"""Text as Column expressions: normal form, tokens, grams, set similarity, id lists, hash split.

Everything is native but Unicode compatibility folding of text outside a safe Latin range, which
goes through one Arrow function that sees such text only.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of legal form and of addresses that carry no identity.
LEGAL = ("inc", "incorporated", "corp", "corporation", "co", "company", "llc", "ltd", "limited", "pvt", "private", "plc", "gmbh", "sarl", "sas", "sa", "the")
ADDRESS_WORDS = (
    "road", "rd", "street", "st", "avenue", "ave", "lane", "ln", "drive", "dr", "building", "bldg", "floor", "fl", "unit", "suite", "ste",
    "near", "opp", "opposite", "district", "dist", "state",
)


def let(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it. Common parts of higher-order
    functions are not shared otherwise, and merged projections repeat them at every use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _folded(s: str) -> str:
    return unicodedata.normalize("NFKC", s).casefold()


@cache
def native_class() -> str:
    """A character class of what lower() folds as well: below U+0250 all that NFKC leaves alone and
    case-folds to its lower case."""
    good = [c for c in range(0x250) if _folded(chr(c)) == chr(c).lower()]
    runs, begin = [], None
    for c in range(0x251):
        if c in good and begin is None:
            begin = c
        elif (c not in good) and begin is not None:
            runs.append((begin, c - 1))
            begin = None
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]"


@cache
def digit_class() -> str:
    """A class of the digits in the sense of str.isdigit: decimal ones and, by enumeration, others."""
    more = [c for c in range(0x110000) if chr(c).isdigit() and unicodedata.category(chr(c)) != "Nd"]
    return "[\\p{Nd}" + "".join(f"\\x{{{c:x}}}" for c in more) + "]"


def normalize(value: Column) -> Column:
    """Compatibility form, case-folded, & as " and ", all but letters, numbers and marks as one space
    (marks stay: Indic vowels are marks); null is empty."""

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.map(_folded, na_action="ignore")

    v = F.replace(F.coalesce(value, F.lit("")), F.lit("ß"), F.lit("ss"))
    native = v.rlike(f"^{native_class()}*$")
    # CASE WHEN doesn't keep rows from a Python function; a null argument does.
    text = F.coalesce(F.when(native, F.lower(v)), fold(F.when(~native, v)))
    return F.trim(F.regexp_replace(F.replace(text, F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{N}\p{M}]+", " "))


def tokens(normal: Column) -> Column:
    return F.filter(F.split(normal, " "), lambda t: t != "")


def without(array: Column, words: tuple[str, ...]) -> Column:
    return F.filter(array, lambda t: ~t.isin(*words))


def name_tokens(normal: Column) -> Column:
    """For keys: order and repeats stay."""
    return F.filter(without(tokens(normal), LEGAL), lambda t: F.char_length(t) > 1)


def address_tokens(normal: Column) -> Column:
    return without(tokens(normal), ADDRESS_WORDS)


def is_digits(t: Column) -> Column:
    return t.rlike(f"^{digit_class()}+$")


def house_numbers(address: Column) -> Column:
    return F.filter(address, lambda t: is_digits(t) & (F.char_length(t) <= 5))


def postal_codes(address: Column) -> Column:
    return F.filter(address, lambda t: is_digits(t) & F.char_length(t).isin(5, 6))


def localities(address: Column) -> Column:
    return F.filter(address, lambda t: t.rlike(r"^\p{L}+$") & (F.char_length(t) >= 4))


def useful_tokens(normal: Column, drop_legal: bool = False) -> Column:
    """For comparison: distinct tokens of two characters or more."""
    words = F.filter(tokens(normal), lambda t: F.char_length(t) > 1)
    return F.array_distinct(without(words, LEGAL) if drop_legal else words)


def number_tokens(normal: Column) -> Column:
    return F.array_distinct(F.filter(tokens(normal), is_digits))


def grams(normal: Column, size: int = 3) -> Column:
    """Distinct character n-grams of the text without spaces; a shorter text is its only one."""

    def of(v: Column) -> Column:
        n = F.char_length(v)
        many = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.substring(v, i, F.lit(size))))
        return F.when(n == 0, F.array().cast("array<string>")).when(n < size, F.array(v)).otherwise(many)

    return let(F.replace(normal, F.lit(" "), F.lit("")), of)


def _ratio(a: Column, b: Column, over: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), over.cast("double")))


def jaccard(a: Column, b: Column) -> Column:
    return _ratio(a, b, F.size(F.array_union(a, b)))


def overlap(a: Column, b: Column) -> Column:
    return _ratio(a, b, F.least(F.size(a), F.size(b)))


def dice(a: Column, b: Column) -> Column:
    return 2.0 * _ratio(a, b, F.size(a) + F.size(b))


def stable_bucket(entity_id: Column, seed: str) -> Column:
    """0 to 9,999 from the first 8 bytes of SHA-256 of the seed, a zero byte and the id."""
    digest = F.sha2(F.concat(F.lit(seed + "\0"), entity_id).cast("binary"), 256)
    return (F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)") % 10_000).cast("int")


def is_holdout(entity_id: Column, folds: int = 5) -> Column:
    return F.substring_index(entity_id, "-", -1).cast("bigint") % folds == 0


def id_list(text: Column) -> Column:
    """A comma list as an array: trimmed, blanks dropped, first of repeated ones kept."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def id_list_broken(text: Column) -> Column:
    """Whether a strict reader refuses the list: an empty or a repeated element."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.when(F.coalesce(text, F.lit("")) == "", False).otherwise(F.exists(parts, lambda x: x == "") | (F.size(F.array_distinct(parts)) < F.size(parts)))


def valid_targets(ids: Column) -> Column:
    return F.filter(ids, lambda x: x.startswith("S2-") | x.startswith("S3-"))


def format_ids(ids: Column) -> Column:
    return F.array_join(F.array_distinct(F.filter(ids, lambda x: x.isNotNull() & (x != ""))), ",")


def f05(n_truth: Column, n_pred: Column, tp: Column) -> Column:
    """F0.5 of one entity: 1 if both sides are empty, 0 if one is or nothing is hit."""
    p, r = F.try_divide(tp.cast("double"), n_pred.cast("double")), F.try_divide(tp.cast("double"), n_truth.cast("double"))
    return F.when((n_truth == 0) & (n_pred == 0), 1.0).when((n_truth == 0) | (n_pred == 0) | (tp == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))
