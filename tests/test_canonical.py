import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from lexmill.errors import CheckpointError
from lexmill.operators import sentences as N
from lexmill.sources import files
from lexmill.streaming import canonical
from lexmill.streaming.canonical import CanonicalState

SCHEMA = "polygon_id string, language string, sentence_text_normalized string, source string, document_id string, section_index long, section_id string, sentence_index long, note string, tags map<string,string>, previous_sentence string, next_sentence string"


def occurrences(spark, count=400, seed=1):
    draw = random.Random(seed)
    rows = [(f"p{draw.randint(0, 3)}", draw.choice(["en", "fr", None]), f"text {draw.randint(0, 12)}", draw.choice(["wikipedia", "wikivoyage"]), f"d{draw.randint(0, 3)}", draw.randint(0, 2), f"s{draw.randint(0, 1)}", draw.randint(0, 2), draw.choice(["a", "b", None]), {"k": draw.choice("xy")}, None, draw.choice(["n", None])) for _ in range(count)]
    return spark.createDataFrame(rows, SCHEMA)


def plain(df):
    return sorted((tuple(sorted((k, str(v)) for k, v in r.asDict().items())) for r in df.collect()))


def test_any_split_gives_the_same_rows(spark, tmp_path):
    whole = occurrences(spark)
    keys = [c for c in N.GROUP]
    rows = whole.collect()
    wanted = plain(N.deduplicate(whole))
    for seed, parts in ((1, 1), (2, 4)):
        draw = random.Random(seed)
        state = CanonicalState(spark, str(tmp_path / str(seed)), buckets=5)
        assert state.rows() is None
        cut = [[] for _ in range(parts)]
        for r in rows:
            draw.choice(cut).append(r)
        for batch, part in enumerate(cut):
            changed = state.update(spark.createDataFrame(part, SCHEMA), batch)
            # What changed are the groups of the batch, as the whole so far has them.
            so_far = N.deduplicate(spark.createDataFrame([r for p in cut[: batch + 1] for r in p], SCHEMA))
            named = {tuple(r[k] for k in keys) for r in part}
            assert plain(changed) == [x for x in plain(so_far) if tuple(None if dict(x)[k] == "None" else dict(x)[k] for k in keys) in named]
        assert plain(state.rows()) == wanted
        # A batch that comes again changes nothing.
        assert state.update(spark.createDataFrame(cut[-1], SCHEMA), parts - 1) is None and plain(state.rows()) == wanted


def test_a_batch_that_broke_off_leaves_the_state(spark, tmp_path, monkeypatch):
    state = CanonicalState(spark, str(tmp_path / "s"), buckets=3)
    first, second = occurrences(spark, 60, 2), occurrences(spark, 60, 3)
    state.update(first, 0)
    before = plain(state.rows())
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(files, "replace", lambda *a: (_ for _ in ()).throw(OSError("broke off")))
        state.update(second, 1)
    assert plain(state.rows()) == before
    state.update(second, 1)
    assert plain(state.rows()) == plain(N.deduplicate(first.union(second)))
    assert state.update(second.limit(0), 2).count() == 0
    with pytest.raises(CheckpointError, match="other columns"):
        state.update(second.drop("note"), 3)
    with pytest.raises(CheckpointError, match="buckets"):
        CanonicalState(spark, str(tmp_path / "s"), buckets=4)


def test_a_stream(spark, tmp_path):
    whole = occurrences(spark, 120, 4)
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    state = CanonicalState(spark, str(tmp_path / "s"), buckets=2)
    for k, part in enumerate(whole.randomSplit([1.0, 1.0], 7)):
        part.coalesce(1).write.mode("append").parquet(source)
        state.run(spark.readStream.schema(whole.schema).parquet(source), checkpoint)
    assert plain(state.rows()) == plain(N.deduplicate(spark.read.parquet(source)))


def test_a_batch_is_added_without_writing_the_state_anew(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(canonical, "PARTS", 2)
    state, whole = CanonicalState(spark, str(tmp_path / "s"), buckets=2), []
    for batch in range(4):
        whole.append(occurrences(spark, 60, batch))
        before = {path for paths in (state._said() or {"paths": {}})["paths"].values() for path in paths}
        changed = state.update(whole[-1], batch)
        after = {path for paths in state._said()["paths"].values() for path in paths}
        so_far = N.deduplicate(reduce(DataFrame.union, whole))
        assert plain(state.rows()) == plain(so_far)
        named = {tuple(r) for r in whole[-1].select(*N.GROUP).collect()}
        assert plain(changed) == plain(spark.createDataFrame([r for r in so_far.collect() if tuple(r[k] for k in N.GROUP) in named], so_far.schema))
        # Parts stay as they are until there would be too many.
        assert before <= after if batch != 2 else not before & after
        assert {p.name for p in (tmp_path / "s").glob("part-*/bucket=*")} and all((tmp_path / "s" / path).exists() for path in after)
