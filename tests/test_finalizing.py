import random

import pytest

from lexmill.plans import finalizing as Z
from lexmill.sources import files

ORDER = ("polygon_id", "n")


def table(spark, count=600):
    draw = random.Random(1)
    rows = [(f"p{draw.randint(0, 40):02d}" if k % 3 else "hot", k, f"text {k}", ["a", None][k % 2]) for k in range(count)]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "polygon_id string, n int, text string, note string").repartition(5)


def in_files(spark, target):
    """Rows in the order of files and places."""
    out = []
    for path in sorted(files.leaves(spark, f"{target}/data")):
        out += [tuple(r) for r in spark.read.parquet(path).select("polygon_id", "n", "text", "note").collect()]
    return out


def test_rows_come_in_order(spark, tmp_path):
    rows, target = table(spark), str(tmp_path / "out")
    said = Z.finalize_in_parts(rows, target, {"v": 1}, order=ORDER, parts=10)
    assert in_files(spark, target) == sorted(map(tuple, rows.collect()), key=lambda r: r[:2])
    assert said["row_count"] == 600 and len(said["files"]) > 5 and max(f["rows"] for f in said["files"].values()) < 200
    assert {n for n, _, _ in files.children(spark, target)} == {"data", "manifest.json"} and not files.exists(spark, f"{target}.parts")
    with pytest.raises(FileExistsError):
        Z.finalize_in_parts(rows, target, {"v": 1}, order=ORDER)
    Z.finalize_in_parts(rows.limit(0), target, {"v": 2}, order=ORDER, overwrite=True)
    assert in_files(spark, target) == []


def test_a_run_that_broke_off_goes_on(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Z, "WAVE", 2)
    rows, target = table(spark), str(tmp_path / "out")
    Z.finalize_in_parts(rows.where("n < 10"), target, {"v": 0}, order=ORDER, parts=2)
    old, hashed, real = in_files(spark, target), [], Z.export.content_hashes

    def counted(df, by):
        if len(hashed) == 2:
            raise RuntimeError("broke off")
        hashed.append(real(df, by))
        return hashed[-1]

    with monkeypatch.context() as m:
        m.setattr(Z.export, "content_hashes", counted)
        with pytest.raises(RuntimeError):
            Z.finalize_in_parts(rows, target, {"v": 1}, order=ORDER, parts=9, overwrite=True)
    assert in_files(spark, target) == old and len(files.children(spark, f"{target}.parts/said")) == 4
    again = []
    monkeypatch.setattr(Z.export, "content_hashes", lambda df, by: (again.append(x := real(df, by)), x)[1])
    # The rows are not even read again: they were dealt out before.
    said = Z.finalize_in_parts(spark.createDataFrame([], rows.schema), target, {"v": 1}, order=ORDER, parts=9, overwrite=True)
    done, more = ({p for h in part for p in h} for part in (hashed, again))
    assert not done & more and len(done) == 4 and len(done | more) == len(said["files"])
    assert in_files(spark, target) == sorted(map(tuple, rows.collect()), key=lambda r: r[:2])


def test_another_identity_begins_anew(spark, tmp_path, monkeypatch):
    rows, target = table(spark, 100), str(tmp_path / "out")
    with monkeypatch.context() as m:
        m.setattr(Z.export, "content_hashes", lambda *a: (_ for _ in ()).throw(RuntimeError("broke off")))
        with pytest.raises(RuntimeError):
            Z.finalize_in_parts(rows, target, {"v": 1}, order=ORDER, parts=3)
    Z.finalize_in_parts(rows.where("n < 50"), target, {"v": 2}, order=ORDER, parts=3)
    assert len(in_files(spark, target)) == 50
