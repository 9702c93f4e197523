"""String expressions: cleaning, tokens, extraction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Character entities and their replacements.
ENTITIES = {
    "&quot;": '"', "&apos;": "'", "&gt;": ">", "&lt;": "<", "&#xA;": " ", "&#xD;": " ", "&mdash": "—",
    "&ndash;": "-", "&nbsp;": " ", "&euro;": "€", "&hellip;": "…", "&thinsp;": " ", "&times;": "×",
    "&asymp;": "≈", "&div;": " ", "&micro;": "µ", "&frac12;": "½", "&pm;": "±",
}
# Token patterns.
WORD_PATTERN = r"[A-Za-z]\w+(?:[-'?]\w+)?"
TFIDF_PATTERN = r"\w\w+"


def clean_line(c: Column) -> Column:
    """Letters and spaces only, lower-cased and trimmed; ``co-op`` becomes ``coop``.

    Two passes over single character ranges (outside space..z, then ``!``..backtick once the
    letters are lower) cost a third of one pass over the class ``[^A-Za-z ]``.
    """
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(c, "[^ -z]", "")), "[!-`]", ""))


def words(c: Column) -> Column:
    """Non-empty space-separated words of the cleaned line."""
    return F.filter(F.split(clean_line(c), " "), lambda w: w != "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]*>", "")


def unescape(c: Column) -> Column:
    """Decode entities; ``&amp;`` first, however often it was escaped again."""
    c = F.regexp_replace(c, "&(amp;)+", "&")
    for entity, char in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def html_to_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(unescape(strip_tags(c)), r"[ \t\r\n]+", " "))


def regex_tokens(c: Column, pattern: str = WORD_PATTERN) -> Column:
    """All matches of the token pattern, in order."""
    return F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1))


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of the group, NULL where the pattern does not occur."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def section_between(c: Column, start: str, end: str) -> Column:
    """Text between the first ``start`` pattern and the next ``end`` pattern, NULL without both."""
    return first_match(c, f"(?s)(?:{start})(.*?)(?:{end})", 1)


def dehyphenate(c: Column) -> Column:
    """Undo line-break hyphenation: ``exam- ple`` becomes ``example``."""
    return F.regexp_replace(c, r"(?<=\w)- (?=\w)", "")


def sentences(c: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` before a capital, and lower-case each first letter."""
    parts = F.split(c, r"(?<=[.!?])\s+(?=[A-Z])")
    return F.transform(parts, lambda s: F.concat(F.lower(F.substring(s, 1, 1)), F.substr(s, F.lit(2))))


def bigrams(tokens: Column) -> Column:
    """Adjacent token pairs as ``array<struct<a, b>>``; empty below two tokens."""
    n = F.size(tokens)
    left, right = F.slice(tokens, 1, F.greatest(n - 1, F.lit(0))), F.slice(tokens, 2, F.greatest(n - 1, F.lit(0)))
    return F.when(n >= 2, F.zip_with(left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b")))) \
            .otherwise(F.array().cast("array<struct<a:string,b:string>>"))


def clean_social(c: Column) -> Column:
    """Mentions followed by a space, URLs up to the line end, punctuation, case and digits, in this order."""
    c = F.regexp_replace(c, r"@[^ \n]* ", "")
    c = F.regexp_replace(c, r"https?://.+$", "")
    c = F.regexp_replace(c, r"[^\w\s]", " ")
    return F.regexp_replace(F.lower(c), "[0-9]", "")


def vocab_size(c: Column) -> Column:
    """Number of distinct cleaned words."""
    return F.size(F.array_distinct(words(c)))


def substring_count(c: Column, text: str) -> Column:
    """Non-overlapping occurrences of a literal substring."""
    return F.try_divide(F.length(c) - F.length(F.replace(c, F.lit(text), F.lit(""))),
                        F.lit(len(text))).cast("bigint")


def code_label(c: Column, labels: Mapping[str, str], default: str | None = None) -> Column:
    """Code -> label through a literal map."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(default))


def bracketed(c: Column) -> Column:
    """Render an array as ``[a,b]``."""
    return F.concat(F.lit("["), F.array_join(c, ","), F.lit("]"))


def name_rules(c: Column, abbreviations: Mapping[str, str]) -> Sequence[Column]:
    """Normal forms of a name, strongest first: as is, no ``'s``, no apostrophe, no spaces, spelled out."""
    plain = F.replace(c, F.lit("&amp;"), F.lit("&"))
    spelled = F.array_join(F.transform(F.split(plain, " "), lambda w: F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in abbreviations.items() for x in kv]), w), w)), " ")
    return [plain, F.replace(plain, F.lit("'s"), F.lit("")), F.replace(plain, F.lit("'"), F.lit("")),
            F.replace(plain, F.lit(" "), F.lit("")), spelled]
