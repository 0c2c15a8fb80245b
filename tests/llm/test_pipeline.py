import os
from collections import Counter

import corpus_pipeline as C
from lexmill.llm import mixing, simhash

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts, seen = [docs.count()], [docs]
    for name, stage in C.STAGES:
        out = stage(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append(docs)
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == seen[0].columns
    texts = [{r["doc_id"]: r["text"] for r in d.collect()} for d in seen[:4]]
    assert texts[1].keys() < texts[0].keys() and texts[2].keys() == texts[1].keys() and texts[3].keys() < texts[2].keys()
    # Of documents that are equal word by word one stays.
    words = Counter(" ".join((t or "").lower().split()) for t in texts[3].values())
    assert max(words.values()) == 1
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    gone = texts[0].keys() - texts[1].keys()
    assert all(label.get(k, 1) == 1 for k in gone)
    mixed = Counter(r["doc_id"] for r in seen[4].collect())
    steps = {}
    for r in mixing.poisson_steps(mixing.rates(seen[3])).collect():
        steps.setdefault(r["__source"], []).append(r["c"])
    drawn = seen[3].select("doc_id", mixing._safe("source").alias("s"), mixing.uniform(mixing.SEED, seen[3]["doc_id"]).alias("u")).collect()
    assert mixed == Counter({r["doc_id"]: n for r in drawn if (n := sum(c <= r["u"] for c in steps[r["s"]]))})
    assert {r["doc_id"] for r in docs.collect()} == set(mixed)


def test_near_duplicates_that_stay_are_apart(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = simhash.drop_near_duplicates(docs).collect()
    sets = [frozenset(simhash.shingle_hashes(r["text"], 5).tolist()) for r in kept]
    close = sum(len(a & b) >= 0.9 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert close == 0


def test_run_gives_the_stages_result(spark):
    assert os.path.exists(SMALL)
    out = C.run(spark, SMALL)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
