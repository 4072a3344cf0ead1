"""String columns with the engine's text semantics: Unicode blanks, ASCII-folded concepts, spelling variants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks as a Unicode-aware scripting language strips them: \s and the four information separators.
BLANK = r"(?U)[\s\x1c-\x1f]"
GREEK = {"α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "ch", "ψ": "ps", "ω": "o"}
GREEK |= {k.upper(): v.capitalize() for k, v in GREEK.items() if k != "ς"}
#: Words that don't count towards an acronym's initials.
SMALL_WORDS = tuple("a an and by for in of on or the to with".split())
#: Words whose presence, with a blank after them, marks a language; French has two that end in an apostrophe.
MARKS = {
    "en": tuple(f"{w} " for w in "are been could from has have is should that the this was were will with would".split()),
    "es": tuple(f"{w} " for w in "de del el en es la las los para por que un una".split()),
    "fr": (*(f"{w} " for w in "dans de des du est la le les pour sont un une".split()), "d'", "l'"),
    "de": tuple(f"{w} " for w in "auf das der die für ist mit sind und werden wird".split()),
}


def strip(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"^{BLANK}+", ""), f"{BLANK}+$", "")


def squeeze(c: Column) -> Column:
    """Runs of blanks become one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{BLANK}+", " "))


def ascii_lower(c: Column) -> Column:
    """Folds A-Z only, as the vocabulary's concepts are compared."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _has_greek(c: Column) -> Column:
    return c.rlike("[" + "".join(GREEK) + "]")


def _spell(c: Column) -> Column:
    single = {k: v for k, v in GREEK.items() if len(v) == 1}
    double = {k: v for k, v in GREEK.items() if len(v) > 1}
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), double.items(), F.translate(c, "".join(single), "".join(single.values())))


def greek(c: Column) -> Column:
    """Greek letters spelt in Latin; null where there is none."""
    return F.when(_has_greek(c), _spell(c))


def greek_tight(c: Column) -> Column:
    """The same without a hyphen right before a Greek letter."""
    return F.when(_has_greek(c), _spell(F.regexp_replace(c, "-(?=[" + "".join(GREEK) + "])", "")))


def spacing(c: Column) -> Column:
    """No blanks round slashes and hyphens; null where that changes nothing."""
    tight = F.regexp_replace(F.regexp_replace(c, r"(?U)\s*/\s*", "/"), r"(?U)\s*-\s*", "-")
    return F.when(tight != c, tight)


def singular(c: Column) -> Column:
    """-ies to -y, -es (not -ases) and -s (not -ss) off, from four characters on; null elsewhere."""
    n = F.length(c)
    cut = lambda k: F.substring(c, F.lit(1), n - k)
    return F.when(n < 4, None).when(c.endswith("ies"), F.concat(cut(3), F.lit("y"))).when(c.endswith("es") & ~c.endswith("ases"), cut(2)).when(c.endswith("s") & ~c.endswith("ss"), cut(1))


def variants(c: Column) -> Column:
    """Array of spellings to try, the given one first; later ones that only differ in case are left out."""
    one = [greek(c), greek_tight(c), spacing(c), singular(c)]
    g, t, s, p = one
    two = [spacing(g), singular(g), spacing(t), singular(t), greek(s), greek_tight(s), singular(s), greek(p), greek_tight(p), spacing(p)]
    every = F.array_compact(F.array(c, *one, *two))
    return F.aggregate(every, F.array().cast("array<string>"), lambda seen, x: F.when(F.exists(seen, lambda y: F.lower(y) == F.lower(x)), seen).otherwise(F.array_append(seen, x)))


def is_acronym(c: Column) -> Column:
    return (F.length(c) > 1) & (c == F.upper(c)) & (c != F.lower(c))


def initials_match(short: Column, full: Column) -> Column:
    """Whether an acronym's letters are the beginning or a part of the long form's initials (no letters are, too)."""
    letters = F.regexp_replace(F.upper(short), "[^A-Z]", "")
    words = F.filter(F.regexp_extract_all(full, F.lit("[A-Za-z]+"), F.lit(0)), lambda w: ~F.lower(w).isin(*SMALL_WORDS))
    first = F.array_join(F.transform(words, lambda w: F.upper(F.substring(w, 1, 1))), "")
    return (F.size(words) > 0) & first.contains(letters)


def truth(c: Column) -> Column:
    """Loose boolean text: positive numbers and true, y, yes."""
    low = F.lower(F.trim(c.cast("string")))
    return F.coalesce(low.try_cast("double") > 0, low.isin("true", "y", "yes"), F.lit(False))


def qid(c: Column) -> Column:
    return F.regexp_extract(F.split_part(c, F.lit("|"), F.lit(1)), r"Q\d+", 0)


def language(c: Column) -> Column:
    """Language by marker words: at least three of one's must occur; the first of en, es, fr, de wins a tie.

    Null and texts of under 20 characters are unknown; Arabic and Chinese go by their script. The text is lower-cased
    once, and the scores are made once, inside a higher-order function.
    """
    scores = lambda low: F.array(*[F.struct(sum((low.contains(m).cast("int") for m in marks), F.lit(0)).alias("n"), F.lit(-i).alias("first"), F.lit(k).alias("lang")) for i, (k, marks) in enumerate(MARKS.items())])
    best = F.element_at(F.transform(F.array(F.lower(c)), lambda low: F.array_max(scores(low))), 1)
    marked = F.element_at(F.transform(F.array(best), lambda x: F.when(x["n"] >= 3, x["lang"]).otherwise("unknown")), 1)
    return F.when(c.isNull() | (F.length(c) < 20), "unknown").when(c.rlike("[؀-ۿ]"), "ar").when(c.rlike("[一-鿿]"), "zh").otherwise(marked)


def affiliation(c: Column) -> Column:
    x = F.regexp_replace(c, r"[\n\t]+", ", ")
    x = F.regexp_replace(x, r"\s*,\s*", ", ")
    return F.btrim(F.regexp_replace(x, r"\s{2,}", " "), F.lit(" ,;"))


def without_direction(c: Column) -> Column:
    """A place name without a leading northern, southern, eastern, western or central; empty if it is only that."""
    return F.trim(F.regexp_replace(c, r"(?i)^\s*(northern|southern|eastern|western|central)\b\s*", ""))


def sample_id(section: Column, start: Column, end: Column) -> Column:
    short = F.when(section.contains("#"), F.substring_index(section, "/", -1)).otherwise(F.substring(F.md5(section), 1, 8))
    return F.concat(short, F.lit("#"), start.cast("string"), F.lit("-"), end.cast("string"))


def parse_sample_id(c: Column) -> Column:
    """Struct of section, start, end; nulls where the text is no sample id."""
    pattern = r"^(.*)#(\d+)-(\d+)$"
    ok = c.rlike(pattern)
    at = lambda k: F.when(ok, F.regexp_extract(c, pattern, k))
    return F.struct(at(1).alias("section_id"), at(2).try_cast("int").alias("start"), at(3).try_cast("int").alias("end"))


def answer_choice(answer: Column, n: Column, strict: bool = False) -> Column:
    """Number of the candidate an answer picks: none if it says reject, else its first digit within 1..n.

    ``strict`` reads whole numbers instead of digits.
    """
    digits = F.transform(F.regexp_extract_all(answer, F.lit(r"\d+" if strict else r"\d"), F.lit(0)), lambda d: d.try_cast("int"))
    return F.when(~F.upper(answer).contains("REJECT"), F.try_element_at(F.filter(digits, lambda d: (d >= 1) & (d <= n)), F.lit(1)))
