"""Licence scan by a positional index of rare words: DataFrame functions only.

Each template's words are ranked by inverse document frequency over all files, and its rarest
ones form the index: word -> (template, relative position). Every occurrence of an indexed word
in a file votes for a template and a place where it would start; a place that enough rare words
agree on is a candidate. A candidate counts if the template's mandatory key phrases stand at
their relative places.

Null texts count as empty: no words, no labels, score 0. Repeated rows are judged each by
itself; an empty table gives no rows. Ties in frequency go to the earlier position. Only the id
and text columns are read.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import LOWER, UPPER, let, texts

WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
RARE = 4  # indexed words per template
AGREE = 0.5  # share of them that must agree on the place


@dataclass(frozen=True)
class Template:
    """A licence notice in lower-case words; ``keys`` are phrases of it that must be present."""

    label: str
    text: str
    keys: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return self.text.split()


def phrase(label: str, text: str) -> Template:
    return Template(label, text, (text,))


# The phrases of the base labels, and the opening notices of common licences.
BASE = (
    phrase("mit", "mit license"),
    phrase("apache", "apache license"),
    phrase("gpl", "general public license"),
)
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
             ("permission is hereby granted free of charge",)),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at",
             ("except in compliance with the license",)),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
             ("gnu general public license",)),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
             ("gnu lesser general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
             ("redistribution and use in source and binary forms",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("for any purpose with or without fee",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("released into the public domain",)),
    phrase("cc-by", "licensed under cc by 4 0"),
    phrase("cc-by-sa", "licensed under cc by sa 4 0"),
    phrase("cc-by-nc", "licensed under cc by nc 4 0"),
    phrase("cc0", "cc0 1 0 universal"),
)
TEMPLATES = BASE + NOTICES


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(1))


def frequencies(rows: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many files each word of the templates occurs; at most one row per word reaches the driver."""
    found = F.array_distinct(F.filter(words_of(F.col("text")), lambda w: w.isin(vocabulary)))
    counts = rows.select(F.explode(found).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return {r["w"]: r["n"] for r in counts.collect()}


def indexed(templates: tuple[Template, ...], df: dict[str, int], n: int, rare: int = RARE, agree: float = AGREE) -> list[dict]:
    """The index: per template its rarest words with relative positions, and its key phrases."""
    out = []
    for t in templates:
        idf = lambda w: math.log((n + 1) / (df.get(w, 0) + 1))
        ranked = sorted(dict.fromkeys(t.words), key=lambda w: (-idf(w), t.words.index(w)))[:rare]
        marks = [{"w": w, "at": i} for i, w in enumerate(t.words) if w in ranked]
        keys = []
        for key in t.keys:
            k = key.split()
            keys.append({"at": next(i for i in range(len(t.words)) if t.words[i : i + len(k)] == k), "ws": k})
        whole = t.words == t.keys[0].split()
        out.append({"label": t.label, "ws": t.words, "marks": marks, "keys": keys, "need": len(marks) if whole else math.ceil(agree * len(marks))})
    return out


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, matches): matches are (template, label, start, share of the template's words in place).

    Two passes over the texts (frequencies, then matches), no shuffle of documents. The index is
    bounded by the templates.
    """
    rows = texts(docs, id_col, text_col)
    n = rows.count()
    df = frequencies(rows, sorted({w for t in templates for w in t.words}))
    index = indexed(templates, df, n)
    key = "array<struct<at:int,ws:array<string>>>"
    kind = f"array<struct<label:string,ws:array<string>,marks:array<struct<w:string,at:int>>,keys:{key},need:int>>"
    book = F.from_json(F.lit(json.dumps(index)), kind)
    postings = F.from_json(
        F.lit(json.dumps([{"w": m["w"], "t": t, "at": m["at"]} for t, x in enumerate(index) for m in x["marks"]])),
        "array<struct<w:string,t:int,at:int>>",
    )
    marks = sorted({m["w"] for x in index for m in x["marks"]})
    shift = 1 << 32  # template and start in one long, starts moved into the positive

    def votes(hits: Column) -> Column:
        each = lambda h: F.transform(
            F.filter(postings, lambda p: p.w == h.w), lambda p: p.t.cast("long") * shift + (h.i - p.at).cast("long") + (1 << 31)
        )
        return F.array_distinct(F.flatten(F.transform(hits, each)))

    def matches(words: Column) -> Column:
        numbered = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        hits = F.filter(numbered, lambda h: h.w.isin(marks))

        def candidate(vote: Column) -> Column:
            start = (vote % shift - (1 << 31)).cast("int")
            return F.struct(start.alias("start"), F.get(book, F.floor(vote / shift).cast("int")).alias("x"), F.floor(vote / shift).cast("int").alias("t"))

        there = lambda c, at: F.when(c.start + at >= 0, F.get(words, c.start + at))
        agreed = lambda c: F.size(F.filter(c.x.marks, lambda m: there(c, m["at"]) == m.w)) >= c.x.need
        phrase_there = lambda c: lambda k: F.when(
            c.start + k["at"] >= 0, F.slice(words, c.start + k["at"] + 1, F.size(k.ws)) == k.ws
        ).otherwise(False)
        placed = F.filter(F.transform(votes(hits), candidate), lambda c: agreed(c) & F.forall(c.x["keys"], phrase_there(c)))
        share = lambda c: F.size(F.filter(F.transform(c.x.ws, lambda w, i: there(c, i) == w), lambda same: same)) / F.size(c.x.ws)
        return F.transform(placed, lambda c: F.struct(c.t.alias("template"), c.x.label.alias("label"), c.start.cast("long").alias("start"), share(c).alias("share")))

    found = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), matches(w).alias("m")))
    return rows.select("doc_id", found.alias("__f")).select("doc_id", F.col("__f.n").alias("n_words"), F.col("__f.m").alias("matches"))
