import random

import pytest
from pyspark.sql import functions as F

from lexmill.llm import substring_dedup as D


def brute(documents, kind, min_words):
    """Units of all documents in order; what was seen before, in runs."""
    seen, out = {}, []
    for k, text in sorted(documents, key=lambda d: d[0]):
        run, last = None, None
        for no, (start, end, words, digest) in enumerate(D.units(text, kind)):
            if digest in seen:
                if run and no == last + 1:
                    run[2], run[3] = end, run[3] + words
                else:
                    if run and run[3] >= min_words:
                        out.append(tuple(run))
                    run = [k, start, end, words, seen[digest]]
                last = no
            seen.setdefault(digest, k)
        if run and run[3] >= min_words:
            out.append(tuple(run))
    return sorted(out)


def corpus(seed=3):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(1, 6))) for _ in range(300)]
    sentence = lambda: " ".join(draw.choices(words, k=draw.randint(2, 14))).capitalize() + draw.choice([".", "!", "?"])
    passages = [" ".join(sentence() for _ in range(8)) for _ in range(4)]
    docs = []
    for k in range(60):
        parts = [sentence() for _ in range(draw.randint(0, 12))]
        if k % 3 == 0:
            parts.insert(draw.randint(0, len(parts)), draw.choice(passages))
        docs.append((k, draw.choice([" ", "\n"]).join(parts)))
    return [*docs, (100, docs[3][1]), (101, docs[4][1])]


def test_units_keep_offsets():
    text = "One two three four five. Six.\nSeven eight nine ten!  Eleven twelve thirteen fourteen"
    parts = lambda kind: [text[a:b] for a, b, _, _ in D.units(text, kind)]
    assert parts("sentence") == ["One two three four five.", "Six.", "Seven eight nine ten!", "Eleven twelve thirteen fourteen"]
    assert parts("line") == text.split("\n") and D.units(text) == D.units(text, "line")
    assert D.units(None) == D.units("") == []
    assert [text[a:b] for a, b, *_ in D.units("a b\n\nc", "paragraph")] == [text[0:3], text[5:6]]


def test_equals_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for n, kind, least in ((1, "sentence", 20), (5, "sentence", 20), (3, "line", 1), (3, "paragraph", 1), (2, "line", 8)):
        wanted = brute(docs, kind, least)
        assert wanted
        out = D.repeated_spans(df.repartition(n), kind=kind, min_words=least)
        assert sorted((r["doc_id"], r["start"], r["end"], r["n_words"], r["first_doc_id"]) for r in out.collect()) == wanted


def test_removal_keeps_offsets(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    spans = D.repeated_spans(df, kind="sentence", min_words=20)
    gone = {}
    for r in spans.collect():
        gone.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
    texts = dict(docs)
    for r in D.remove_spans(df, spans).collect():
        original = texts[r["doc_id"]]
        assert r["text"] == "".join(original[a:b] for a, b in r["kept"])
        assert sum(b - a for a, b in r["kept"]) == len(original) - sum(b - a for a, b in gone.get(r["doc_id"], []))


def test_edges(spark):
    long = "word " * 30 + "end."
    rows = [(1, long, 1), (1, long, 1), (2, long, 2), (None, long, 3), (3, None, 4), (4, "", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest int")
    assert sorted((r["doc_id"] is None, r["n_words"]) for r in D.repeated_spans(df).collect()) == [(False, 31), (True, 31)]
    assert D.repeated_spans(df.limit(0)).count() == 0


def test_lines_of_any_length_go(spark):
    rows = [(1, "Thank you.\nfirst own line"), (2, "second own line\n  thank  YOU.\nThank you."), (3, "Thank you.\nThank you."), (4, "x\n" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["doc_id"], r["start"], r["end"], r["first_doc_id"]) for r in D.repeated_spans(df).collect())
    assert found == [(2, 18, 40, 1), (3, 0, 21, 1), (4, 2, 599_999, 4)]
    left = {r["doc_id"]: r["text"] for r in D.remove_spans(df, D.repeated_spans(df)).collect()}
    assert left == {1: rows[0][1], 2: "second own line\n  ", 3: "", 4: "x\n\n"}


def test_runs_over_indented_and_short_lines(spark):
    words = [f"w{i}" for i in range(600)]
    indented = "\n".join("    " + " ".join(words[12 * k : 12 * k + 12]) for k in range(6))
    verse = "\n".join(" ".join(words[300 + 3 * k : 303 + 3 * k]) for k in range(20))
    left = "\n".join(" ".join(words[400 + 12 * k : 410 + 12 * k]) + ". One end." for k in range(5))
    texts = [f"here begins text number {2 * k + copy}\n{t}\nand here ends text {2 * k + copy}" for k, t in enumerate((indented, verse, left)) for copy in range(2)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["n_words"] for r in D.repeated_spans(df, kind="sentence", min_words=20).collect()}
    # Of verse the first line is told by the line before it.
    assert found == {1: 72, 3: 57, 5: 60}


def test_removal_by_key_and_text(spark):
    shared = "a long line that stands here"
    rows = [(1, shared, "first"), (2, f"uu vv ww {shared[:5]}", "other text"), (2, f"own words\n{shared}", "has the span"), (None, f"before\n{shared}\nafter", "null key"), (3, None, "null text"), (4, "", "empty"), (5, "plain", "untouched")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _spans string")
    spans = D.repeated_spans(df)
    out = {r["_spans"]: r for r in D.remove_spans(df, spans, kept="left").collect()}
    assert {k: r["text"] for k, r in out.items()} == {"first": shared, "other text": rows[1][1], "has the span": "own words\n", "null key": "before\n\nafter", "null text": None, "empty": "", "untouched": "plain"}
    assert [tuple(x) for x in out["null key"]["left"]] == [(0, 7), (35, 41)] and out["null text"]["left"] == [] and [tuple(x) for x in out["untouched"]["left"]] == [(0, 5)]
    for name in ("_key", "_hash", "_gone", "__lexmill_spans", "start", "spans"):
        clash = df.withColumnRenamed("_spans", name)
        again = D.remove_spans(clash, spans)
        assert again.columns == [*clash.columns, "kept"] and {r[name]: r["text"] for r in again.collect()} == {k: r["text"] for k, r in out.items()}
    with pytest.raises(ValueError, match="kept"):
        D.remove_spans(df.withColumnRenamed("_spans", "kept"), spans)


def test_spans_that_overlap_are_one(spark):
    df = spark.createDataFrame([(1, "0123456789")], "doc_id long, text string")
    spans = df.select("doc_id", F.xxhash64("text").alias("text_hash"), F.inline(F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((1, 4), (2, 3), (3, 6), (8, 9))])))
    (r,) = D.remove_spans(df, spans).collect()
    assert r["text"] == "0679" and [tuple(x) for x in r["kept"]] == [(0, 1), (6, 8), (9, 10)]


def test_rows_that_repeat_key_and_text(spark):
    text = "the first line is here\nthe second line is there"
    df = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text")).union(spark.createDataFrame([(3, text)], "doc_id long, text string"))
    assert [(r["doc_id"], r["start"], r["end"], r["first_doc_id"]) for r in D.repeated_spans(df).collect()] == [(7, 0, len(text), 3)]


def test_a_text_of_several_megabytes(spark):
    lines = [f"line {k} of one long text" for k in range(200_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["own", *lines[:100_000], "own end"]))]
    assert len(rows[0][1]) > 5_000_000
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = D.repeated_spans(df)
    assert [(r["doc_id"], r["n_words"]) for r in spans.collect()] == [(2, 600_000)]
    assert {r["doc_id"]: len(r["text"]) for r in D.remove_spans(df, spans).collect()} == {1: len(rows[0][1]), 2: len("own\n\nown end")}
