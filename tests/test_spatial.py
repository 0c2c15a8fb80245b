import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill import queries
from lexmill.functions import hexagons as H
from lexmill.functions import spatial


def spread(count, seed=1):
    p = np.random.default_rng(seed).normal(size=(count, 3))
    p /= np.linalg.norm(p, axis=1, keepdims=True)
    return np.degrees(np.arcsin(p[:, 2])), np.degrees(np.arctan2(p[:, 1], p[:, 0]))


@pytest.mark.parametrize(("lat", "lon", "resolution", "name"), [
    (37.3615593, -122.0553238, 7, "87283472bffffff"),
    (37.775938728915946, -122.41795063018799, 9, "8928308280fffff"),
    (40.689167, -74.044444, 10, "8a2a1072b59ffff"),
    (0.0, 0.0, 5, "85754e67fffffff"),
    (0.0, 0.0, 0, "8075fffffffffff"),
])
def test_published_indexes(lat, lon, resolution, name):
    assert H.names(H.cells(np.array([lat]), np.array([lon]), resolution)) == [name]


def test_base_cells_follow_latitude_and_corners_are_the_published_pentagons():
    _, _, face, place, corner, around = H._base()
    lat = np.arcsin(H._lift(H._plane(place), face)[:, 2])
    assert (np.diff(lat) <= 1e-12).all()
    assert np.flatnonzero(corner).tolist() == [4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117]
    # Faces that have a corner behind them, as published.
    assert {c: sorted(f for f, k in ring if k == 1) for c, ring in around.items()} == {4: [], 14: [2, 6], 24: [1, 5], 38: [3, 7], 49: [0, 9], 58: [4, 8], 63: [11, 15], 72: [12, 16], 83: [10, 19], 97: [13, 17], 107: [14, 18], 117: []}


def every_cell(resolution):
    out = []
    corner = H._base()[4]
    for base in range(122):
        for n in range(7**resolution):
            digits = [n // 7**k % 7 for k in range(resolution)][::-1]
            lead = next((d for d in digits if d), 0)
            if corner[base] and lead == 1:
                continue
            index = (1 << 59) | (resolution << 52) | (base << 45) | ((1 << 45) - 1)
            for r, d in enumerate(digits):
                index ^= (7 ^ d) << (3 * (14 - r))
            out.append(index)
    return out


@pytest.mark.parametrize("resolution", [0, 1, 2, 3])
def test_every_cell_is_found_from_its_centre(resolution):
    cells = every_cell(resolution)
    assert len(cells) == 2 + 120 * 7**resolution
    centres = np.array([H.centre(c) for c in cells])
    assert (H.cells(centres[:, 0], centres[:, 1], resolution) == np.array(cells)).all()


@pytest.mark.parametrize("resolution", [4, 9, 15])
def test_centres_of_finer_cells(resolution):
    lat, lon = spread(300, resolution)
    # Also right beside corners of the icosahedron and the poles.
    corners = np.array([H.centre(c) for c in every_cell(0) if H._base()[4][c >> 45 & 127]])
    lat = np.concatenate((lat, corners[:, 0] + 1e-3, corners[:, 0] - 2e-3, [90, -90, 0, 0]))
    lon = np.concatenate((lon, corners[:, 1], corners[:, 1] + 1e-3, [0, 10, 180, -180]))
    cells = H.cells(lat, lon, resolution)
    centres = np.array([H.centre(c) for c in cells.tolist()])
    assert (H.cells(centres[:, 0], centres[:, 1], resolution) == cells).all()


def area(corners):
    """Of a polygon on the unit sphere, by the angles of triangles from its middle."""
    p = H._globe(*np.radians(np.array(corners)).T)
    m = p.mean(axis=0)
    m /= np.linalg.norm(m)
    total = 0.0
    for a, b in zip(p, np.roll(p, -1, axis=0), strict=True):
        total += 2 * math.atan2(m @ np.cross(a, b), 1 + m @ a + a @ b + b @ m)
    return total


@pytest.mark.parametrize("resolution", [0, 1, 2])
def test_outlines_tile_the_globe(resolution):
    areas = [area(H.outline(c)) for c in every_cell(resolution)]
    assert min(areas) > 0 and abs(sum(areas) - 4 * math.pi) < 1e-9


def winds(corners, p):
    """How often the outline goes around a point, counter-clockwise; outlines over an edge need not be convex."""
    x = np.cross(p, [0.3, 0.5, 0.8])
    y = np.cross(p, x)
    angle = np.arctan2(corners @ y, corners @ x)
    return round(float(((np.roll(angle, -1) - angle + np.pi) % (2 * np.pi) - np.pi).sum() / (2 * np.pi)))


def test_outlines_hold_their_points():
    for resolution in (1, 2, 3, 5, 8):
        lat, lon = spread(400, resolution + 20)
        cells = H.cells(lat, lon, resolution)
        for c, p in zip(cells.tolist(), H._globe(np.radians(lat), np.radians(lon)), strict=True):
            assert winds(H._globe(*np.radians(np.array(H.outline(c))).T), p) == 1


def test_pentagons_have_their_corners():
    for resolution, corners in ((0, 5), (1, 10), (2, 5), (3, 10)):
        for c in every_cell(resolution):
            digits = [c >> (3 * (14 - r)) & 7 for r in range(resolution)]
            if H._base()[4][c >> 45 & 127] and not any(digits):
                assert len(H.outline(c)) == corners


def test_outline_across_the_antimeridian():
    (cell,) = H.cells(np.array([10.0]), np.array([179.99]), 3).tolist()
    lon = [x for _, x in H.unwrapped(H.outline(cell))]
    assert max(lon) - min(lon) < 5 and min(lon) < -180
    (cell,) = H.cells(np.array([10.0]), np.array([20.0]), 3).tolist()
    assert H.unwrapped(H.outline(cell)) == H.outline(cell)


def test_columns(spark):
    rows = [(48.85, 2.35), (48.86, 2.36), (-34.6, -58.4), (None, 1.0), (1.0, None), (float("nan"), 1.0), (91.0, 0.0), (0.0, 181.0), (float("inf"), 0.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    counts = {r["cell"]: r["n"] for r in spatial.h3_histogram(df).collect()}
    assert sum(n for c, n in counts.items() if c) == 3 and len(counts) == 3 and counts[None] == 6
    assert [r[0] for r in spatial.bad_coordinates(df).collect()] == ["NaN 1.0", "91.0 0.0", "0.0 181.0", "Infinity 0.0"]
    assert spatial.bad_coordinates(df, in_range=False).count() == 2
    # The third cell lies over an edge of the icosahedron.
    outlines = spatial.with_cell(df.limit(4)).select("lat", spatial.h3_outline(F.col("cell")).alias("o"), spatial.h3_centre(F.col("cell")).alias("c")).collect()
    assert [len(r["o"]) if r["o"] else None for r in outlines] == [6, 6, 7, None] and outlines[3]["c"] is None and abs(outlines[0]["c"]["lat"] - 48.85) < 2
    with pytest.raises(ValueError):
        spatial.h3_cell(F.col("lat"), F.col("lon"), 16)


def test_query(spark):
    rows = queries._customers_on_the_globe(spark, "/root/testdata/sf0.001").collect()
    placed = [(r["lat"], r["lon"]) for r in rows if r["lat"] is not None and r["lon"] is not None]
    names = H.names(H.cells(*np.array(placed).T, 3))
    found = {r["cell"]: r for r in queries.h3_histogram(spark, "/root/testdata/sf0.001").collect()}
    assert {c: r["n"] for c, r in found.items() if c} == {c: names.count(c) for c in names} and found[None]["n"] == len(rows) - len(placed)
    for (y, x), c in zip(placed, names, strict=True):
        # Beside the poles an outline's extent does not bound its points.
        r = found[c]
        assert abs(y) > 85 or (r["south"] - 0.1 <= y <= r["north"] + 0.1 and any(r["west"] - 0.1 <= x + turn <= r["east"] + 0.1 for turn in (-360, 0, 360)))
