"""The pipeline's stages, each against brute force on what its predecessor kept."""

import public_tokenizers as P
from test_jaccard_lm import brute as near_brute
from test_pii_toxicity import plain_spans
from test_rules_licenses_decontam import brute as leak_brute
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from telemill.llm import jaccard, pii, toxicity
from telemill.llm.common import remainder


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    texts = {r.doc_id: r.text for r in docs.collect()}

    kept = stages["toxicity"](spark, docs, small).cache()
    model = toxicity.fit(docs, spark.read.parquet(f"{small}/labels.parquet"), lambda i: remainder(i, 4) != 2)
    expect = {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted == 0}
    assert {r.doc_id for r in kept.collect()} == expect and kept.columns == docs.columns

    ids = sorted(expect)
    classes, _ = near_brute([texts[i] for i in ids])
    wordless = {i for i in ids if not len(jaccard.shingles(texts[i] or ""))}
    expect = {ids[c] for i, c in zip(ids, classes) if i not in wordless} | wordless
    kept = stages["near_duplicates"](spark, kept, small).cache()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expect) and kept.columns == docs.columns

    leaks = leak_brute({i: texts[i] for i in expect}, items)
    expect = {i for i in expect if not leaks[i][1]}
    kept = stages["decontamination"](spark, kept, small).cache()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expect) and kept.columns == docs.columns

    found = pii.fit(kept)
    clean = stages["personal_data"](spark, kept, small).cache()
    rows = {r.doc_id: r for r in clean.collect()}
    assert rows.keys() == expect and clean.columns == docs.columns
    for i, r in rows.items():
        assert r.text == pii.redacted(texts[i], pii.spans_of(texts[i], found)) and r.n_chars == len(r.text)
        assert not plain_spans(r.text)

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    packed = stages["packing"](spark, clean, small).collect()
    lengths = {i: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in rows.items()}
    assert {i: sum(p.length for p in packed if p.doc_id == i) for i in rows} == lengths
    assert pipeline.run(spark, small).count() == len(packed)
