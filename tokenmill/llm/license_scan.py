"""License texts: exact set-similarity join of text blocks with templates, and fixed phrases."""

from __future__ import annotations

import re
from fractions import Fraction
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import ALNUM_WORD, map_texts

# fixed values: phrases and their labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: usual license notices, each with the label that it gives
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2.0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license"),
    ("cc-by", "licensed under a creative commons attribution license"),
    ("all-rights-reserved", "all rights reserved"),
]

CONTAINMENT = Fraction(4, 5)
#: A block is so many times as long as its template, in words.
STRETCH = 2


def tokens_of(text: str) -> frozenset[bytes]:
    return frozenset(re.findall(ALNUM_WORD, text.encode().lower()))


def token_frequencies(docs: DataFrame, tokens: set[bytes], text_col: str = "text") -> DataFrame:
    """(token, n_docs) over all documents, for the templates' tokens: counted in tasks, then summed."""
    wanted = frozenset(tokens)
    # tokens are ASCII words, so one search per text for any of them is enough
    found = map_texts(
        docs.select(F.lit(0).alias("_one"), text_col),
        "_one",
        text_col,
        "found array<string>",
        lambda: lambda text: (
            [t.decode() for t in wanted.intersection(re.findall(ALNUM_WORD, text.encode().lower()))],
        ),
    )
    return found.select(F.explode("found").alias("token")).groupBy("token").agg(F.count("*").alias("n_docs"))


def prefix_index(templates, order: dict[bytes, int], threshold: Fraction) -> tuple[list, dict[bytes, list]]:
    """Templates as token lists by global rank, and for each prefix token the (template, position) it stands at.

    A block that holds ``need`` of a template's n tokens misses at most n - need of them, so it
    holds one of the n - need + 1 first.
    """
    ranked, index = [], {}
    for number, (label, text) in enumerate(templates):
        tokens = sorted(tokens_of(text), key=lambda t: (order.get(t, 0), t))
        need = ceil(threshold * len(tokens))
        ranked.append((label, tokens, need))
        for position, token in enumerate(tokens[: len(tokens) - need + 1]):
            index.setdefault(token, []).append((number, position))
    return ranked, index


def license_scan(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: Fraction = CONTAINMENT,
    stretch: int = STRETCH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``n_words``, ``places``: (label, word) of every phrase, ``blocks``: (label, word, words, containment).

    Blocks are all runs of ``stretch`` times as many consecutive words as the template has, however they are divided
    into lines; at the end of a text they are shorter. A block is found if it holds at least ``threshold`` of the template's distinct
    words. Reported are those that begin with one of these words: ``words`` until enough are together, and
    the ``containment`` of the whole block.

    First pass: how many documents hold each template word (all documents, summed in tasks), which
    gives the global order, rarest first. Second pass: a text is looked into only for templates of which it
    holds one of the rarest words, the prefix; then the length filter (it needs as many distinct words of the template as a block), the positional
    filter (words of the template behind the first one that it holds must reach the need) and the exact count in
    windows that move over the places of the template's words. Templates are a short list given by the
    caller, and only they and their counts reach the driver. No shuffle of texts.

    Null and empty texts have no words and no places. Rows with equal ids each keep a result;
    other columns are not read.
    """
    vocabulary = set().union(*(tokens_of(text) for _, text in templates)) if templates else set()
    counts = token_frequencies(docs, vocabulary, text_col).collect()  # one row per template word at most
    order = {row["token"].encode(): row["n_docs"] for row in counts}
    ranked, index = prefix_index(templates, order, threshold)
    lengths = [len(re.findall(ALNUM_WORD, text.encode().lower())) for _, text in templates]
    phrases = [(phrase.encode().split(), label) for phrase, label in PHRASES.items()]

    def setup():
        word = re.compile(ALNUM_WORD)
        wanted = frozenset(vocabulary)
        endings = {}
        for phrase, label in phrases:
            endings.setdefault(phrase[-1], []).append((phrase, label))

        def found_in(places: dict[bytes, list[int]]) -> list[dict]:
            """Blocks of all templates in a text with these places of template words."""
            blocks = []
            held = sorted({number for token in places.keys() & index.keys() for number, _ in index[token]})
            for number in held:
                label, tokens, need = ranked[number]
                there = [i for i, token in enumerate(tokens) if token in places]
                if len(there) < need or len(tokens) - there[0] < need:
                    continue
                hits = sorted((at, i) for i in there for at in places[tokens[i]])
                counts, distinct, end, size = [0] * len(tokens), 0, 0, stretch * lengths[number]
                for begin, (at, token) in enumerate(hits):
                    while end < len(hits) and hits[end][0] < at + size:
                        distinct += counts[hits[end][1]] == 0
                        counts[hits[end][1]] += 1
                        end += 1
                    if distinct >= need:
                        seen, reach = set(), at
                        for place, i in hits[begin:end]:
                            seen.add(i)
                            if len(seen) >= need:
                                reach = place
                                break
                        blocks.append({"label": label, "word": at, "words": reach - at + 1, "containment": distinct / len(tokens)})
                    counts[token] -= 1
                    distinct -= counts[token] == 0
            return blocks

        def scan(text: str) -> tuple:
            data = text.encode().lower()
            words = word.findall(data)
            held = set(words)
            places, blocks = [], []
            for ending, ended in endings.items():
                at = -1
                for _ in range(words.count(ending) if ending in held else 0):
                    at = words.index(ending, at + 1)
                    for phrase, label in ended:
                        first = at - len(phrase) + 1
                        if first >= 0 and words[first : at + 1] == phrase:
                            places.append({"label": label, "word": first})
            if not index.keys().isdisjoint(held):
                at_words: dict[bytes, list[int]] = {}
                for k, w in enumerate(words):
                    if w in wanted:
                        at_words.setdefault(w, []).append(k)
                blocks = found_in(at_words)
            return len(words), sorted(places, key=lambda p: (p["word"], p["label"])), blocks

        return scan

    fields = (
        "n_words bigint, places array<struct<label:string,word:bigint>>, "
        "blocks array<struct<label:string,word:bigint,words:bigint,containment:double>>"
    )
    return map_texts(docs, id_col, text_col, fields, setup)
