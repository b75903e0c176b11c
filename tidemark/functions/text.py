"""Column expressions over text: tokens, hashes, label parsing, n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: runs of two or more word characters, the usual word analyser.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Fixed value: the alphabet of summary tokens.
SUMMARY_TOKEN_PATTERN = "[a-z0-9]+"

# Fixed value: white space as Python's str.strip sees it within ASCII.
STRIP_PATTERN = r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$"


def tokens(text: Column) -> Column:
    """Lower-cased word tokens with multiplicity; an empty array for null text."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def summary_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(SUMMARY_TOKEN_PATTERN), F.lit(0))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, STRIP_PATTERN, "")


def ngrams(words: Column, n: int) -> Column:
    """Space-joined runs of n neighbouring words."""
    return F.when(
        F.size(words) >= n,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (n - 1)),
            lambda i: F.array_join(F.slice(words, i, n), " "),
        ),
    ).otherwise(F.array().cast("array<string>"))


def hash_int(key: Column, seed: str | int = 42) -> Column:
    """32 bits of md5 over ``seed:key`` as a non-negative bigint."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column, buckets: int, seed: str | int = 42) -> Column:
    return hash_int(key, seed) % F.lit(buckets)


def parse_label(answer: Column, labels: list[str]) -> Column:
    """The first label that a generated answer equals or begins with, else ``unknown``."""
    cleaned = F.lower(strip(answer))
    hits = [F.when(cleaned.startswith(label), F.lit(label)) for label in labels]
    return F.coalesce(*hits, F.lit("unknown"))


def map_values(value: Column, mapping: dict) -> Column:
    """Dictionary lookup; a value without an entry becomes null."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(table, value)


def sentence_count(text: Column) -> Column:
    """Sentences: non-blank pieces between runs of ``.``, ``!`` and ``?``."""
    pieces = F.split(text, r"[.!?]+")
    return F.size(F.filter(pieces, lambda p: F.length(strip(p)) > 0))
