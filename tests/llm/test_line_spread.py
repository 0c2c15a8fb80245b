import random

from lexmill.llm import line_spread as L


def brute(rows, least):
    """Cleaned texts; rows: key, text, site, with keys that differ."""
    spread, first = {}, {}
    for k, text, site in sorted(rows, key=lambda r: r[0]):
        for place, line in enumerate((text or "").split("\n")):
            if plain := L.normalise(line):
                spread.setdefault(plain, set()).add(site)
                first.setdefault(plain, (k, place))
    gone = lambda k, place, line: len(spread.get(L.normalise(line), ())) >= least and (k, place) > first[L.normalise(line)]
    return {k: None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if not gone(k, n, x)) for k, text, _ in rows}


def test_equals_brute_force(spark):
    draw = random.Random(1)
    common = [f"Common Line {i}" for i in range(8)]
    rows = []
    for k in range(150):
        lines = [draw.choice([f"own {k} {i}", draw.choice(common[: 1 + k % 8]), "", f"few {draw.randint(0, 30)}"]) for i in range(draw.randint(0, 9))]
        rows.append((k, "\n".join(lines), draw.choice(["a", "b", "c", "d", "e", "f", "g", None])))
    rows += [(500, None, "a"), (501, "", "b"), (502, "\n\n", "c"), (503, "COMMON  line 0\ncommon line 0", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for least in (2, 5):
        out = {r["doc_id"]: r["text"] for r in L.drop_spread_lines(df.repartition(3), min_sites=least).collect()}
        assert out == brute(rows, least)
    assert any(out[k] != t for k, t, _ in rows)


def test_far_counts_come_from_sketches(spark):
    rows = [(k, "everywhere\n" + "own " * (k % 3 + 1) + str(k), f"site{k}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r["text"] for r in L.drop_spread_lines(df, min_sites=50).collect()}
    assert out == brute(rows, 50)


def test_edges(spark):
    df = spark.createDataFrame([(None, "x", "a", 1), (1, "x", "b", 1), (1, "x", "b", 1), (2, "x", "c", 1)], "doc_id long, text string, source string, line int")
    out = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in L.drop_spread_lines(df, min_sites=3).collect())
    assert out == [(False, 1, "x"), (False, 1, "x"), (False, 2, ""), (True, 0, "")]
    assert L.drop_spread_lines(df.limit(0)).count() == 0


def test_long_texts_and_clashing_names(spark):
    long = "\n".join(f"line {k % 3}" if k % 3 else f"own {k}" for k in range(60_000))
    rows = [(k, long if k == 9 else "line 1\nline 2\nmy own", f"site{k}", 1, 2, 3) for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __removed int, _k int, _gone int")
    out = L.drop_spread_lines(df, places="at")
    assert out.columns == [*df.columns, "at"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[0]["text"] == rows[0][1] and got[0]["at"] is None and got[5]["text"] == "my own" or got[5]["text"] == ""
    assert got[9]["text"] == "\n".join(f"own {k}" for k in range(0, 60_000, 3)) and len(got[9]["at"]) == 40_000
    assert L.drop_spread_lines(df).columns == df.columns
