"""Text normalisation as column expressions: nothing here leaves the JVM."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .constants import DEVANAGARI, DOMAIN, HANDLE, LEGAL_FORMS, NOT_WORD, NULL_WORDS, STREET


@cache
def _accents() -> tuple[str, str]:
    """Characters of the basic plane that decompose to one base letter and marks, and those letters."""
    src, dst = [], []
    for cp in range(0x80, 0xFFFF):
        c = chr(cp)
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF:
            continue
        d = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(d) == 1 and d != c:
            src.append(c)
            dst.append(d)
    return "".join(src), "".join(dst)


def strip_accents(s: Column) -> Column:
    return F.regexp_replace(F.translate(s, *_accents()), "\\p{Mn}", "")


def collapse(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, "\\s+", " "))


def is_null_word(s: Column) -> Column:
    return s.isNull() | F.lower(s).isin(*NULL_WORDS)


def has_devanagari(s: Column) -> Column:
    return F.coalesce(s.rlike("[\\x{0900}-\\x{097F}]"), F.lit(False))


def transliterate(s: Column) -> Column:
    """Letter by letter; then runs of single letters become one word."""
    one = {k: v for k, v in DEVANAGARI.items() if len(v) == 1}
    out = F.translate(s, "".join(one), "".join(one.values()))
    for k, v in DEVANAGARI.items():
        if len(v) != 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    return F.regexp_replace(collapse(out), "(?<=(?<![^ ])\\p{L}) (?=\\p{L}(?![^ ]))", "")


def normalize_text(s: Column, domains: bool = False, business: bool = True) -> Column:
    """Trimmed, lower-cased, without accents, white space collapsed; null and the words for it are empty. With
    domains, handles and domain endings go; .biz and .info only with business."""
    ending = DOMAIN if business else DOMAIN.replace("|biz|info", "")
    t = strip_accents(F.lower(F.trim(F.coalesce(s, F.lit("")))))
    t = F.when(t.isin("nan", "null", "none"), "").otherwise(t)
    if domains:
        t = F.regexp_replace(F.regexp_replace(t, f"(?i){HANDLE}", " "), f"(?i){ending}", " ")
    return collapse(t)


def clean_brand(df: DataFrame, name: str) -> DataFrame:
    """Adds brand, legal, name_translit. Each step is a column of its own, so it is computed once."""
    s = strip_accents(F.lower(F.trim(F.col(name))))
    s = F.regexp_replace(F.regexp_replace(s, f"(?i){HANDLE}", " "), f"(?i){DOMAIN}", " ")
    df = df.withColumn("__s", F.when(is_null_word(F.col(name)), "").otherwise(s))
    which = F.coalesce(*(F.when(F.col("__s").rlike(f"(?U){pattern}"), k) for k, (pattern, _) in enumerate(LEGAL_FORMS)), F.lit(-1))
    df = df.withColumn("__k", which)
    legal, rest = F.lit(""), F.col("__s")
    for k, (pattern, form) in reversed(list(enumerate(LEGAL_FORMS))):
        hit = F.col("__k") == k
        legal, rest = F.when(hit, form).otherwise(legal), F.when(hit, F.regexp_replace("__s", f"(?U){pattern}", " ")).otherwise(rest)
    df = df.withColumns({"legal": legal, "__r": rest, "name_translit": has_devanagari(F.col(name)) & ~is_null_word(F.col(name))})
    latin = F.when(F.col("name_translit"), transliterate(F.col("__r"))).otherwise(F.col("__r"))
    return df.withColumn("brand", collapse(F.regexp_replace(latin, NOT_WORD, " "))).drop("__s", "__k", "__r")


def expand_street(words: Column) -> Column:
    names = F.create_map(*(F.lit(x) for kv in STREET.items() for x in kv))
    return F.transform(words, lambda w: F.coalesce(F.element_at(names, w), w))


def clean_address(df: DataFrame, address: str) -> DataFrame:
    """Adds addr, zip, nums (distinct, sorted as text), words, has_addr, addr_translit."""
    null = is_null_word(F.col(address)) | (F.trim(F.col(address)) == "")
    s = strip_accents(F.lower(F.trim(F.col(address))))
    df = df.withColumns({"has_addr": ~null, "addr_translit": has_devanagari(F.col(address)) & ~null})
    s = F.when(F.col("addr_translit"), transliterate(s)).otherwise(s)
    s = collapse(F.regexp_replace(s, NOT_WORD, " "))
    df = df.withColumn("addr", F.when(F.col("has_addr"), F.array_join(expand_street(F.split(s, " ")), " ")).otherwise(""))
    df = df.withColumn("__n", F.regexp_extract_all("addr", F.lit("(?U)\\b\\d+\\b"), F.lit(0)))
    df = df.withColumn("zip", F.coalesce(F.get(F.filter("__n", lambda n: F.length(n).isin(5, 6)), 0), F.lit("")))
    nums = F.array_sort(F.array_distinct(F.filter("__n", lambda n: (n != F.col("zip")) & (F.length(n) <= 5))))
    words = F.filter(F.split("addr", " "), lambda w: (F.length(w) >= 3) & ~w.rlike("^\\p{Nd}+$"))
    return df.withColumns({"nums": nums, "words": words}).drop("__n")


def silver(entities: DataFrame) -> DataFrame:
    """The eight normalised fields beside entity_id, src, country."""
    df = clean_address(clean_brand(entities, "business_name"), "business_address")
    return df.select("entity_id", F.substring("entity_id", 1, 2).alias("src"), "country", "brand", "legal", "addr", "has_addr", "nums", "zip", "words", (F.col("name_translit") | F.col("addr_translit")).alias("is_translit"))


def extract_nums(s: Column) -> Column:
    """Numbers of at most 5 digits without leading zeros."""
    return F.array_distinct(F.transform(F.filter(F.regexp_extract_all(s, F.lit("(?U)\\b\\d+\\b"), F.lit(0)), lambda n: F.length(n) <= 5), lambda n: n.cast("int").cast("string")))


def char_grams(s: Column) -> Column:
    """Distinct 3- and 4-grams with white space as _, but for those that begin or end with __."""
    t = F.regexp_replace(s, "\\s+", "_")
    grams = lambda n: F.when(F.length(t) >= n, F.transform(F.sequence(F.lit(1), F.length(t) - (n - 1)), lambda i: F.substring(t, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.filter(F.array_distinct(F.concat(grams(3), grams(4))), lambda g: ~g.startswith("__") & ~g.endswith("__"))


def skeleton(token: Column) -> Column:
    """First letter and following consonants, runs collapsed, at most 6; null if under 3."""
    raw = F.concat(F.substring(token, 1, 1), F.regexp_replace(token.substr(F.lit(2), F.length(token)), "[aeiouy]", ""))
    out = F.substring(F.regexp_replace(raw, "(.)\\1+", "$1"), 1, 6)
    return F.when((F.length(token) >= 4) & (F.length(raw) >= 3) & (F.length(out) >= 3), out)


def id_list(s: Column) -> Column:
    """A comma list of ids, trimmed, without blanks; first mentions in order."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(s, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""))


def bucket(sid: Column) -> Column:
    return (F.crc32(sid) % 1000).cast("int")


def safe_name(s: str) -> str:
    """For file names: all but letters and digits of ASCII become _."""
    return "".join(c if c.isascii() and c.isalnum() else "_" for c in s)
