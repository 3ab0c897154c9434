"""Licence scan by a positional rare-token index (DataFrame operations only).

A *template* is a licence notice or name as a list of words with mandatory key
phrases, some of its positions. A text has the template's label where all key
phrases stand at their places and ``LEAST_SHARE`` of all its words do.

Index. For every key phrase the higher half of its distinct words by inverse
document frequency (over all documents) is indexed with their positions in
the template. A file's words that are in the index, its highest-IDF licence
words, are looked up; every posting names a template and the relative position
at which it would begin. The postings are intersected: a beginning that not
all indexed words of the key phrases agree on is dropped. At those left the
key phrases are verified word by word and the share is counted. As each key
phrase is mandatory and has an indexed word, no place is lost, whichever
words happen to be rare.

Base phrases (gpl, apache, cc-by, mit) are templates that are one key phrase;
every place of them counts. The other labels are the method's own: the usual
notices and names of more licences.

Scale. Two scans: one counts the documents of each template word (one row per
word, bounded by the templates, is collected), one looks the texts up. All
else stays inside a row, so there is no shuffle and no hot key. Sorting the
beginnings of a text makes the intersection linear in its licence words.

Defined results. A null text is empty; a text without licence words has no
places, empty labels and score 0. Places may overlap. Repeated rows each get
their row and a row's id is only passed through. Words are as in
``decontaminate.words``. Columns besides the two are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import col
from rivulet.llm.decontaminate import words
from rivulet.llm.pii import let

LEAST_SHARE = 0.75


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    phrases: tuple[tuple[int, ...], ...]  # positions of each key phrase
    base: bool = False

    @property
    def must(self) -> list[int]:
        return sorted({i for p in self.phrases for i in p})


def template(label: str, text: str, *phrases: str, base: bool = False) -> Template:
    """A template of a text and its key phrases (none: the whole text is one).
    A key phrase must be part of the text; its first place counts."""
    def split(s):
        return tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", s.lower()))
    body, places = split(text), []
    for phrase in phrases or (text,):
        key = split(phrase)
        at = next((i for i in range(len(body) - len(key) + 1) if body[i:i + len(key)] == key), None)
        if at is None or not key:
            raise ValueError(f"{phrase!r} is no part of the template {label}")
        places.append(tuple(range(at, at + len(key))))
    return Template(label, body, tuple(places), base)


# Base phrases, then names and notices of common licences.
TEMPLATES = [
    template("gpl", "gnu general public license", base=True),
    template("apache", "apache license", base=True),
    template("cc-by", "cc by", base=True),
    template("mit", "mit license", base=True),
    template("lgpl", "gnu lesser general public license"),
    template("agpl", "gnu affero general public license"),
    template("mpl", "mozilla public license"),
    template("epl", "eclipse public license"),
    template("bsd", "bsd license"),
    template("bsd", "bsd 3 clause"),
    template("bsd", "bsd 2 clause"),
    template("isc", "isc license"),
    template("zlib", "zlib license"),
    template("boost", "boost software license"),
    template("artistic", "artistic license"),
    template("unlicense", "free and unencumbered software released into the public domain"),
    template("cc0", "cc0 1 0 universal"),
    template("cc-by-sa", "cc by sa"),
    template("cc-by-nc", "cc by nc"),
    template("cc-by-nd", "cc by nd"),
    template("cc-by-sa", "creative commons attribution sharealike"),
    template("cc-by-nc", "creative commons attribution noncommercial"),
    template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files (the Software), to deal in the Software without restriction",
             "permission is hereby granted free of charge", "to deal in the software without restriction"),
    template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met", "redistribution and use in source and binary forms"),
    template("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
             "except in compliance with the License",
             "you may not use this file except in compliance with the license"),
    template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
             "GNU General Public License as published by the Free Software Foundation",
             "free software you can redistribute it", "gnu general public license"),
    template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
             "without fee is hereby granted", "for any purpose with or without fee is hereby granted"),
    template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License",
             "source code form is subject to the terms of the mozilla public license"),
]


def document_counts(docs: DataFrame, templates: list[Template], text: str = "text") -> dict[str, int]:
    """How many rows hold each word of the templates' key phrases."""
    known = sorted({t.words[i] for t in templates for i in t.must})
    found = (docs.select(F.explode(F.array_intersect(words(col(text)), _strings(known))).alias("word"))
             .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    return dict.fromkeys(known, 0) | {r.word: r.n for r in found.collect()}


def rare_words(t: Template, counts: dict[str, int]) -> set[int]:
    """The indexed positions: of every key phrase the places of the higher
    half of its distinct words by IDF (ties: in order of the words)."""
    chosen = set()
    for phrase in t.phrases:
        by_idf = sorted({t.words[i] for i in phrase}, key=lambda w: (counts[w], w))
        rare = set(by_idf[:max(1, len(by_idf) // 2)])
        chosen |= {i for i in phrase if t.words[i] in rare}
    return chosen


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _ints(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def places(docs: DataFrame, templates: list[Template] = TEMPLATES, text: str = "text",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and n_words and places of every row: an array of
    (label, base, start, length, share), by template and start."""
    counts = document_counts(docs, templates, text)
    chosen = [sorted(rare_words(t, counts)) for t in templates]
    postings = F.array(*[F.struct(F.lit(t.words[i]).alias("word"), F.lit(n).alias("t"), F.lit(i).alias("at"))
                         for n, t in enumerate(templates) for i in chosen[n]])
    indexed = sorted({t.words[i] for t, at in zip(templates, chosen) for i in at})
    agreeing = _ints([len(at) for at in chosen])
    of = F.array(*[F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
                            _strings(t.words).alias("words"), _ints(t.must).alias("must")) for t in templates])

    def beginnings(hits):
        return F.sort_array(F.flatten(F.transform(hits, lambda h: F.transform(
            F.filter(postings, lambda p: p["word"] == h["word"]),
            lambda p: F.struct(p["t"].alias("t"), (h["at"] - p["at"]).alias("start"))))))

    def agreed(all_):
        def ends_run(i):
            # the last of equal beginnings, if there are as many as there must be
            here, need = F.get(all_, i), F.get(agreeing, F.get(all_, i)["t"])
            after = F.get(all_, i + 1)
            return ((after.isNull() | (after != here)) & (i + 1 >= need)
                    & F.coalesce(F.get(all_, i + 1 - need) == here, F.lit(False)))
        return F.when(F.size(all_) > 0, F.transform(
            F.filter(F.sequence(F.lit(0), F.size(all_) - 1), ends_run), lambda i: F.get(all_, i)))

    def verified(at):
        def look(t):
            stands = lambda j: F.coalesce(
                F.get(F.col("words"), at["start"] + j) == F.get(t["words"], j), F.lit(False))
            n = F.size(F.filter(F.sequence(F.lit(0), F.size(t["words"]) - 1), stands))
            return F.struct(t["label"].alias("label"), t["base"].alias("base"), at["start"].alias("start"),
                            F.size(t["words"]).alias("length"),
                            F.when(F.forall(t["must"], stands), n / F.size(t["words"])).alias("share"))
        return let(F.get(of, at["t"]), look)

    rare = F.col("words")
    hits = F.when(F.arrays_overlap(rare, _strings(indexed)), F.filter(
        F.transform(rare, lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
        lambda h: h["word"].isin(indexed)))
    split = docs.select(*[col(c) for c in keep], words(col(text)).alias("words"))
    found = split.select(*[col(c) for c in keep], "words", hits.alias("hits"))
    return found.select(
        *[col(c) for c in keep], F.size("words").cast("long").alias("n_words"),
        F.coalesce(F.when(F.size("hits") > 0, F.filter(F.transform(
            let(beginnings(F.col("hits")), agreed), verified), lambda p: p["share"] >= LEAST_SHARE)),
            F.array().cast("array<struct<label:string,base:boolean,start:int,length:int,share:double>>"))
        .alias("places"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         templates: list[Template] = TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_words, n_base (places of base phrases), first_word
    and last_word (their least and largest start), base_labels, labels and
    score (the largest share of a template's words at their places; 0: none)."""
    both = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"].cast("long"))

    def names(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda p: p["label"]))), ",")
    return places(both, templates, "text", keep=("doc_id",)).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"))
