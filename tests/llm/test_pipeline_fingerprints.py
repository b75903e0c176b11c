import random

import corpus_pipeline
from tidemark.llm import simhash


def test_pipeline_drops_texts_of_near_fingerprints(spark):
    """Different orders of equal parts: fingerprints within four bits, though the shingle sets are less than 0.8 alike."""
    rng = random.Random(5)
    schema = "doc_id long, text string"
    base = [f"w{rng.randint(0, 9)}" for _ in range(8)] * 40
    texts = [" ".join(base), " ".join(base[:300] + [f"v{i}" for i in range(20)]), " ".join(f"u{i}" for i in range(300))]
    docs = spark.createDataFrame(list(enumerate(texts, 1)), schema).repartition(2)
    prints = {r.doc_id: r.fingerprint for r in simhash.fingerprints(docs).collect()}
    assert ((prints[1] ^ prints[2]) & (2**64 - 1)).bit_count() <= 4
    assert {r.doc_id for r in corpus_pipeline.fingerprints(spark, docs, "").collect()} == {1, 3}
    assert [name for name, _ in corpus_pipeline.STAGES].index("fingerprints") == 2


def test_pipeline_has_the_stages_of_its_operators_in_order(spark):
    """Quality, lines, near-duplicates by both measures, decontamination, pieces: near-duplicates are one stage."""
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "fingerprints", "decontamination", "sentencepiece"
    ]
    rng = random.Random(9)
    long = [f"w{rng.randint(0, 900)}" for _ in range(400)]
    few = [f"w{rng.randint(0, 9)}" for _ in range(8)] * 40
    texts = [
        " ".join(long), " ".join(x if i % 40 else f"z{i}" for i, x in enumerate(long)),  # sets 0.76 alike or more apart
        " ".join(long[:380] + ["tail"]),  # sets 0.8 alike
        " ".join(few), " ".join(few[:300] + [f"v{i}" for i in range(20)]),  # fingerprints within four bits
        " ".join(f"u{i}" for i in range(300)), None, None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string").repartition(3)
    by_print = corpus_pipeline.fingerprints(spark, docs, "")
    both = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, by_print, "").collect()}
    stage = corpus_pipeline.STAGES[2][1]
    assert {r.doc_id for r in stage(spark, docs, "").collect()} == both
    assert {1, 4, 6} <= both and not {3, 5} & both
