"""Rule ledger, licence scan and decontamination against brute force."""

import hashlib
import re
from collections import Counter

import pytest
from compare import database, differences
from helpers import AWKWARD, PROSE, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from telemill.llm import decontam, licenses, queries, rules

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


REPEATS = ["a b c d e f g h i a b c d e f g h", "x " * 40, f"{PROSE}\n{PROSE}\n#$ {PROSE}", "1 2 3 4 5 6 7 8 9 " * 3, "a\x0bb\x0cc #*$%&|<> \r\n a\x0bb\x0cc #*$%&|<> \r\n"]


def test_ledger_measures(spark):
    texts = AWKWARD + REPEATS
    for r in rules.ledger(documents(spark, texts)).collect():
        assert {k: r[k] for k in measures("")} == measures(texts[r.doc_id]), texts[r.doc_id]


def test_ledger_matches_sql(spark, small):
    assert differences(queries.op5_rule_ledger(spark, small), database(small), queries.SQL["op5_rule_ledger"]) == []


def test_policies_and_ablations(spark):
    texts = AWKWARD + REPEATS
    book = rules.ledger(documents(spark, texts)).cache()
    failed = {r.doc_id: {x.name for k, x in enumerate(rules.RULES) if r.failed >> k & 1} for r in book.collect()}
    for version, names in rules.POLICIES.items():
        kept = {r.doc_id for r in rules.applied(book, version).collect() if r.kept}
        assert kept == {i for i, f in failed.items() if not f & set(names)}
        for r in rules.ablations(book, version).collect():
            assert r.n_failed == sum(r.rule in f for f in failed.values())
            assert r.n_only == sum(f & set(names) == {r.rule} for f in failed.values())
            assert (r.n, r.kept) == (len(texts), len(kept))
    sides = {(r.kept_old, r.kept_new): r.n for r in rules.changed(book, "base", "v2").collect()}
    assert sum(sides.values()) == len(texts) and (False, True) not in sides
    assert rules.ledger(documents(spark, ["a"]).limit(0)).count() == 0


LICENCES = [
    "MIT License", "Released under the MIT License. mit   license, the Apache-License", "GNU General\nPublic License and the general public licence",
    "General public public license; general public license", "Licensed under CC BY-NC 4.0.", "license mit", "MİT license " + "mit " * 500,
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "Permission is hereby granted, free of charges to any person", "You may not use THIS file except in compliance with the License. You may obtain a copy of the License at",
    "Redistribution and use in source and binary forms, with or without modifications, are permitted provided that the following conditions are met:",
]


def base(text):
    words, found = plain(text), []
    for label, phrase in (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")):
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(found)


@pytest.mark.parametrize("source", ["small", "awkward"])
def test_base_phrases(spark, small, tmp_path, source):
    if source == "awkward":
        documents(spark, AWKWARD + LICENCES).write.parquet(str(tmp_path / "documents.parquet"))
    folder = small if source == "small" else str(tmp_path)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op7_license_index(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, found = base(texts[r.doc_id])
        labels = ",".join(sorted({x for _, x in found}))
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(found), labels)
        assert (r.first_word, r.last_word) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert set(labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1 or not found)


def test_notices(spark):
    got = {r.doc_id: {(m.label, m.start) for m in r.matches} for r in licenses.scan(documents(spark, LICENCES)).collect()}
    assert ("cc-by-nc", 0) in got[4]
    assert ("mit", 0) in got[7] and not got[8]  # a broken key phrase doesn't count
    assert ("apache", 0) in got[9] and ("bsd", 0) in got[10]
    assert licenses.scan(documents(spark, ["a"]).limit(0)).count() == 0


def brute(texts, items, span=10):
    out = {}
    for d, text in texts.items():
        words, hit, names = plain(text), set(), set()
        for item, it in items:
            w = plain(it)
            k = min(len(w), span)
            windows = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
            for i in range(len(words) - k + 1):
                if k and tuple(words[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    names.add(str(item))
        out[d] = (len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest())
    return out


def hits(docs, items, **options):
    found = {}
    for r in decontam.decontaminate(docs, items, **options).collect():
        names = hashlib.sha256(",".join(r["items"]).encode()).hexdigest()
        found[r.doc_id] = (r.n_words, sum(s.e - s.s for s in r.spans), len(r["items"]), names)
    return found


def test_decontaminate_awkward(spark):
    long = " ".join(f"w{i}" for i in range(60))
    items = [(1, long), (2, long), (10, "Short item, here"), (3, "the"), (4, None), (5, ""), (6, " ".join(f"w{i}" for i in range(30, 50))), (7, "a b c d e f g h i"), (8, "z z z z z z z z z z z z")]
    texts = AWKWARD + [long, f"x {' '.join(f'w{i}' for i in range(5, 15))} y", f"x {' '.join(f'w{i}' for i in range(5, 14))} y", "a SHORT, item. here! the short item", "z " * 40, "a b c d e f g h i j", long + " " + long]
    table = spark.createDataFrame(items, "item_id long, text string")
    expect = brute(dict(enumerate(texts)), items)
    assert hits(documents(spark, texts), table) == expect
    assert hits(documents(spark, texts), table, bits=8, salts=3) == expect  # a full filter changes nothing
    assert hits(documents(spark, texts), table.limit(0)) == brute(dict(enumerate(texts)), [])
    assert hits(documents(spark, texts).limit(0), table) == {}


@given(st.lists(st.sampled_from("abc"), max_size=60), st.lists(st.sampled_from("abc"), min_size=10, max_size=30))
@settings(max_examples=300, deadline=None)
def test_every_shared_span_is_found(doc, item):
    h, g = decontam.word_hashes(" ".join(doc)), decontam.word_hashes(" ".join(item))
    ours, theirs = (list(decontam.fingerprints(x, 10, 5)) for x in (h, g))
    found = set()
    if len(h) >= 10:
        for a in ours:
            for b in theirs:
                if a[0] == b[0]:
                    for s, e in decontam.shared_runs(a[3], a[1] - a[2], b[3], b[1] - b[2], 10):
                        found |= set(range(a[2] + s, a[2] + e))
    windows = {tuple(item[i : i + 10]) for i in range(len(item) - 9)}
    expect = {j for i in range(len(doc) - 9) if tuple(doc[i : i + 10]) in windows for j in range(i, i + 10)}
    assert found == expect


def test_decontaminate_matches_sql(spark, small):
    assert differences(queries.op8_winnowing(spark, small), database(small), queries.SQL["op8_winnowing"]) == []
