"""License scan: exact containment join of text blocks against license templates.

Tokens of all templates are ordered by their document frequency in the whole corpus, rarest first. A block
can reach the containment threshold of a template only if it has one of the template's first
``m - o + 1`` tokens (prefix filter, ``o`` the least overlap of a template of ``m`` tokens), at least ``o``
template tokens (length filter), and enough tokens left behind the first shared one (positional filter).
Blocks that pass are counted in full, so the result equals the comparison of every block with every
template. The templates are a bounded parameter, so their index lives in the expressions of the scan: the
join needs no shuffle, and no source, document or phrase can become a hot key. Only the frequencies of
template tokens (a few dozen rows) reach the driver.

Blocks are all windows of ``block_words`` consecutive words. A block that reaches the threshold keeps all its template
tokens when it begins at the first of them, and holds a prefix token; so blocks are opened at the places of template
tokens close before a prefix token alone, in documents that pass the prefix and length filters. Words are runs of characters outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after
lower-casing A to Z.

Defined results
---------------
* Null or empty text: no words, no places, empty labels, score 0. An empty table gives an empty result.
* Each row is judged alone, so repeated rows and ids give repeated results.
* Ties of the frequency order are broken by the token; they never change the result.
* Only the named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"

# Phrases whose places are reported, with their labels (fixed values).
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Notices the scan looks for, as (label, wording).
TEMPLATES = (
    ("apache", "licensed under the apache license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "licensed under the gnu general public license"),
    ("mit", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("no-warranty", "the software is provided as is without warranty of any kind"),
    ("reserved", "copyright all rights reserved"),
)
THRESHOLD = 0.9
BLOCK_WORDS = 64


@dataclass(frozen=True)
class Template:
    label: str
    tokens: tuple[str, ...]  # distinct, rarest first
    least: int

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.tokens[: len(self.tokens) - self.least + 1]


def least_overlap(tokens: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * tokens - 1e-9))


# The two characters outside ASCII whose lower case holds an ASCII letter (fixed values), and what stands in for them.
_FOLDING, _STAND_INS = "\u0130\u212a", "\u0131\u0138"


def lowered(text: Column) -> Column:
    """A to Z in lower case; null is empty. Other scripts are lowered too, which changes no ASCII letter and no end of a word."""
    text = F.coalesce(text, F.lit(""))
    folds = F.contains(text, F.lit(_FOLDING[0])) | F.contains(text, F.lit(_FOLDING[1]))
    return F.lower(F.when(folds, F.translate(text, _FOLDING, _STAND_INS)).otherwise(text))


def words_of(low: Column) -> Column:
    return F.array_remove(F.split(low, SEPARATOR), "")


def _array(tokens) -> Column:
    return F.array(*[F.lit(t) for t in tokens])


def token_frequencies(words: DataFrame, tokens: list[str]) -> dict[str, int]:
    """Number of rows of all of ``words`` that hold each token."""
    found = words.select(F.explode(F.array_intersect(_array(tokens), "words")).alias("token"))
    return {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}


def ordered_templates(frequencies: dict[str, int], templates=TEMPLATES, threshold: float = THRESHOLD) -> list[Template]:
    rank = lambda t: (frequencies.get(t, 0), t)
    out = []
    for label, wording in templates:
        tokens = tuple(sorted(set(wording.split()), key=rank))
        out.append(Template(label, tokens, least_overlap(len(tokens), threshold)))
    return out


def _containment(block: Column, t: Template) -> Column:
    """Share of the template in a block of ordered template tokens; 0 below the threshold."""
    tokens, prefix = _array(t.tokens), _array(t.prefix)
    first = F.element_at(F.array_intersect(block, prefix), 1)
    behind = F.least(F.lit(len(t.tokens)) - F.array_position(tokens, first),
                     F.size(block) - F.array_position(block, first))
    shared = F.size(F.array_intersect(block, tokens))
    return (F.when(F.size(block) < t.least, 0.0)
            .when(~F.arrays_overlap(block, prefix), 0.0)
            .when(1 + behind < t.least, 0.0)
            .when(shared < t.least, 0.0)
            .otherwise(shared / F.lit(len(t.tokens))))


def _best_block(t: Template) -> Column:
    return F.array_max(F.transform("blocks", lambda block: _containment(block, t)))


def _blocks(by_rank: list[str], prefixes: list[str], block_words: int) -> Column:
    """Ordered template tokens of the blocks that begin at a template token close before a prefix token."""
    word = lambda i: F.element_at("words", i)
    spots = F.filter(F.sequence(F.lit(1), F.size("words")), lambda i: F.array_contains(_array(prefixes), word(i)))
    around = F.transform(spots, lambda p: F.filter(
        F.sequence(F.greatest(F.lit(1), p - (block_words - 1)), p), lambda i: F.array_contains(_array(by_rank), word(i))))
    starts = F.array_distinct(F.flatten(around))
    return F.transform(starts, lambda i: F.array_intersect(_array(by_rank), F.slice("words", i, F.lit(block_words))))


def phrase_pattern(phrase: str) -> str:
    return f"(?<!{_WORD}){SEPARATOR.join(phrase.split())}(?!{_WORD})"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
         threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row: id, n_words, places of the base phrases, base and all labels, score.

    ``score`` is the largest template containment found, 1 where a base phrase stands.
    """
    longest = max(len(w.split()) for _, w in templates)
    if longest > block_words:
        raise ValueError(f"blocks of {block_words} words are shorter than a template of {longest}")
    rows = docs.select(F.col(id_col).alias("doc_id"), lowered(F.col(text_col)).alias("low"))
    universe = sorted({t for _, w in templates for t in w.split()})
    frequencies = token_frequencies(rows.select(words_of(F.col("low")).alias("words")), universe)
    ordered = ordered_templates(frequencies, templates, threshold)
    by_rank = sorted(universe, key=lambda t: (frequencies.get(t, 0), t))

    anywhere = "|".join(phrase_pattern(p) for p, _ in PHRASES)
    rows = rows.select("doc_id", "low", words_of(F.col("low")).alias("words"))
    said = sorted({w for phrase, _ in PHRASES for w in phrase.split()})
    rows = rows.select("*", F.array_intersect(_array(by_rank), "words").alias("known"), F.array_intersect(_array(said), "words").alias("said"))
    # The pattern is looked for only where all words of a phrase occur.
    hinted = F.lit(False)
    for phrase, _ in PHRASES:
        hinted = hinted | (F.size(F.array_intersect("said", _array(phrase.split()))) == len(set(phrase.split())))
    rows = rows.select("*", F.when(hinted, F.regexp_count("low", F.lit(anywhere))).otherwise(0).cast("long").alias("n_base"))
    place = lambda greedy: F.size(words_of(F.regexp_extract("low", f"(?s)^(.*{greedy})(?:{anywhere})", 1)))
    based = F.col("n_base") > 0
    base_labels = F.when(based, F.array_compact(F.array(*[
        F.when(F.col("low").rlike(phrase_pattern(p)), F.lit(label)) for p, label in PHRASES])))
    # A document without a single prefix token has no block to compare.
    possible = F.lit(False)
    for t in ordered:
        possible = possible | (F.arrays_overlap("known", _array(t.prefix)) & (F.size("known") >= t.least))
    prefixes = sorted({token for t in ordered for token in t.prefix})
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), "n_base",
                       F.when(based, place("?")).cast("long").alias("first_word"),
                       F.when(based, place("")).cast("long").alias("last_word"),
                       F.coalesce(base_labels, F.array().cast("array<string>")).alias("base"),
                       F.when(possible, _blocks(by_rank, prefixes, block_words)).alias("blocks"))
    rows = rows.select("*", *[F.when(F.col("blocks").isNotNull(), _best_block(t)).alias(f"t{k}") for k, t in enumerate(ordered)])
    labels = F.array_compact(F.array(*[F.when(F.col(f"t{k}") > 0, F.lit(t.label)) for k, t in enumerate(ordered)]))
    best = F.greatest(F.lit(0.0), *[F.coalesce(F.col(f"t{k}"), F.lit(0.0)) for k in range(len(ordered))])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                       joined(F.col("base")).alias("base_labels"),
                       joined(F.concat("base", labels)).alias("labels"),
                       F.when(F.col("n_base") > 0, 1.0).otherwise(best).alias("score"))
