"""Cells of the H3 grid: hexagons on the faces of an icosahedron, by the published definition of the system.

A point goes to the nearest face and is projected onto its plane from the centre
of the globe.  There a lattice of hexagons, seven times as fine at each
resolution and turned by 19.1 degrees at every other one, gives a hexagon; its
parents are found up to the 122 base cells, and the index holds the base cell
and a digit of direction for each step down.  Everything works on arrays.

Only the faces' centres and axes and the base cells' places are given.  How the
faces' lattices go over into each other, which cells an edge or a corner shares,
and how far digits turn between faces follow from these by geometry.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# Latitude and longitude of the faces' centres, and the azimuth of their first axis.
_FACES = np.array([
    (0.803582649718989942, 1.248397419617396099, 5.619958268523939882), (1.307747883455638156, 2.536945009877921159, 5.760339081714187279),
    (1.054751253523952054, -1.347517358900396623, 0.780213654393430055), (0.600191595538186799, -0.450603909469755746, 0.430469363979999913),
    (0.491715428198773866, 0.401988202911306943, 6.130269123335111400), (0.172745327415618701, 1.678146885280433686, 2.692877706530642877),
    (0.605929321571350690, 2.953923329812411617, 2.982963003477243874), (0.427370518328979641, -1.888876200336285401, 3.532912002790141181),
    (-0.079066118549212831, -0.733429513380867741, 3.494305004259568154), (-0.230961644455383637, 0.506495587332349035, 3.003214169499538391),
    (0.079066118549212831, 2.408163140208925497, 5.930472956509811562), (0.230961644455383637, -2.635097066257444203, 0.138378484090254847),
    (-0.172745327415618701, -1.463445768309359553, 0.448714947059150361), (-0.605929321571350690, -0.187669323777381622, 0.158629650112549365),
    (-0.427370518328979641, 1.252716453253507838, 5.891865957979238535), (-0.600191595538186799, 2.690988744120037492, 2.711123289609793325),
    (-0.491715428198773866, -2.739604450678486295, 3.294508837434268316), (-0.803582649718989942, -1.893195233972397139, 3.804819692245439833),
    (-1.307747883455638156, -0.604647643711872080, 3.664438879055192436), (-1.054751253523952054, 1.794075294689396615, 2.361378999196363184),
])

# Face and place on its lattice of each base cell, in order; a place of 200 is a corner, where five faces meet.
_BASE_CELLS = """
    1:100 2:110 1:000 2:100 0:200 1:110 1:001 2:000 0:100 2:010 1:010 1:011 3:100 3:110 11:200 4:100 0:000 6:010 0:001 2:011
    7:001 2:001 0:110 6:001 10:200 6:000 3:000 11:100 4:110 3:010 0:011 4:000 5:010 0:010 7:010 11:110 7:000 10:100 12:200 6:101
    7:101 4:001 3:001 3:011 4:010 6:100 11:000 8:001 5:001 14:200 5:000 12:100 10:110 4:011 12:110 7:100 11:010 10:000 13:200 10:001
    11:001 9:010 8:010 6:200 8:000 9:001 14:100 5:101 16:011 8:101 5:100 12:000 7:200 12:010 10:010 9:000 13:100 16:001 15:011 15:010
    16:010 14:110 13:110 5:200 8:100 14:000 9:101 14:001 17:001 12:001 16:000 17:011 15:001 16:101 9:100 15:000 13:000 8:200 13:010 17:101
    19:010 14:010 19:011 17:010 13:001 17:000 16:100 9:200 15:101 15:100 18:011 18:001 19:001 17:100 19:000 18:010 18:101 19:200 19:100 18:000
    19:101 18:100
"""

# The length of the lattice's unit on a face's plane at resolution 0, and the turn of odd resolutions.
_UNIT = 0.38196601125010500003
_TURN = 0.333473172251832115336
FINEST = 15
# Digits of the six directions, counter-clockwise from the first axis: I, IJ, J, JK, K, IK.
_AROUND = np.array([4, 6, 2, 3, 1, 5])
_K, _OWN = 1, 3
#: A digit turned by 60 degrees, either way.
_CCW, _CW = np.arange(7), np.arange(7)
_CCW[_AROUND], _CW[_AROUND] = np.roll(_AROUND, -1), np.roll(_AROUND, 1)
#: The directions that a corner's cell has, counter-clockwise from its own face's; K is left out.
_CORNER = [3, 5, 4, 6, 2]
_ROOT = np.sqrt(3) / 2
#: Lattice vectors of the digits, along the axes i and j.
_STEP = np.array([(0, 0), (-1, -1), (0, 1), (-1, 0), (1, 0), (0, -1), (1, 1)])
_EDGE = 1e-9


def _plane(ij: np.ndarray) -> np.ndarray:
    """Places on the lattice as points of the plane, complex."""
    return ij[..., 0] - 0.5 * ij[..., 1] + 1j * _ROOT * ij[..., 1]


def _nearest(z: np.ndarray) -> np.ndarray:
    """The lattice's place nearest to each point of the plane."""
    j = z.imag / _ROOT
    i = z.real + 0.5 * j
    low = np.stack((np.floor(i), np.floor(j)), axis=-1)
    corners = low[..., None, :] + np.array([(0, 0), (1, 0), (0, 1), (1, 1)])
    best = np.abs(_plane(corners) - z[..., None]).argmin(axis=-1)
    return np.take_along_axis(corners, best[..., None, None], axis=-2)[..., 0, :].astype(np.int64)


def _coarser(ij: np.ndarray, odd: bool) -> np.ndarray:
    """The parent of places of an odd or even resolution."""
    i, j = ij[..., 0], ij[..., 1]
    a, b = (3 * i - j, i + 2 * j) if odd else (2 * i + j, 3 * j - i)
    return np.stack((np.rint(a / 7), np.rint(b / 7)), axis=-1).astype(np.int64)


def _finer(ij: np.ndarray, odd: bool) -> np.ndarray:
    """The middle child, of an odd or even resolution."""
    i, j = ij[..., 0], ij[..., 1]
    return np.stack((2 * i + j, 3 * j - i) if odd else (3 * i - j, i + 2 * j), axis=-1)


def _globe(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    return np.stack((np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)), axis=-1)


@cache
def _frames() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each face, its centre on the globe and the directions of its plane's two axes."""
    lat, lon, azimuth = _FACES.T
    centre = _globe(lat, lon)
    north = np.stack((-np.sin(lat) * np.cos(lon), -np.sin(lat) * np.sin(lon), np.cos(lat)), axis=-1)
    east = np.stack((-np.sin(lon), np.cos(lon), np.zeros_like(lon)), axis=-1)
    # Azimuths go clockwise from north, angles of the plane counter-clockwise.
    x = north * np.cos(azimuth)[:, None] + east * np.sin(azimuth)[:, None]
    y = north * np.sin(azimuth)[:, None] - east * np.cos(azimuth)[:, None]
    return centre, x, y


def _project(points: np.ndarray, face: np.ndarray) -> np.ndarray:
    centre, x, y = (a[face] for a in _frames())
    depth = (points * centre).sum(axis=-1)
    return ((points * x).sum(axis=-1) + 1j * (points * y).sum(axis=-1)) / depth / _UNIT


def _lift(z: np.ndarray, face: np.ndarray) -> np.ndarray:
    centre, x, y = (a[face] for a in _frames())
    points = centre + _UNIT * (z.real[..., None] * x + z.imag[..., None] * y)
    return points / np.linalg.norm(points, axis=-1, keepdims=True)


_CORNERS = np.array([(2, 0), (0, 2), (-2, -2)])  # of a face, on its axes i, j and k


@cache
def _edges() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Across the edge opposite each corner: the face there, and the turn and shift into its plane."""
    corners = _lift(np.tile(_plane(_CORNERS), (20, 1)), np.arange(20)[:, None].repeat(3, axis=1))
    z = _plane(_CORNERS)
    near = np.zeros((20, 3), np.int64)
    turn, shift = np.zeros((20, 3), complex), np.zeros((20, 3), complex)
    for face in range(20):
        for across in range(3):
            a, b = (across + 1) % 3, (across + 2) % 3
            for other in range(20):
                gap = np.linalg.norm(corners[other][None] - corners[face][[a, b]][:, None], axis=-1)
                if other != face and (gap.min(axis=1) < 1e-6).all():
                    at, bt = gap.argmin(axis=1)
                    w = (z[bt] - z[at]) / (z[b] - z[a])
                    near[face, across], turn[face, across], shift[face, across] = other, w / abs(w), z[at] - w / abs(w) * z[a]
    return near, turn, shift


def _turns(w: complex) -> int:
    return round(np.angle(w) / (np.pi / 3)) % 6


@cache
def _base() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict]:
    """By face and place: base cell, turns of its digits; of base cells: face, place, whether a corner; of corners: their faces in order."""
    homes = [(int(f), np.array((int(p[0]) - int(p[2]), int(p[1]) - int(p[2])))) for f, p in (x.split(":") for x in _BASE_CELLS.split())]
    face, place = np.array([f for f, _ in homes]), np.array([p for _, p in homes])
    corner = np.array([tuple(p) == (2, 0) for p in place])
    near, turn, shift = _edges()
    cells, turns = np.full((20, 7, 7), -1), np.zeros((20, 7, 7), np.int64)
    around: dict[int, list[tuple[int, int]]] = {}
    middle = _lift(_plane(place), face)
    vertex = _lift(np.tile(_plane(_CORNERS), (20, 1)), np.arange(20)[:, None].repeat(3, axis=1))
    for cell in range(len(homes)):
        if corner[cell]:
            # Faces around a corner, counter-clockwise from its own, with the corner's place on each.
            there = {f: int(k) for f, k in zip(*np.nonzero(np.linalg.norm(vertex - middle[cell], axis=-1) < 1e-6), strict=True)}
            ring, f = [], int(face[cell])
            for n in range(5):
                ring.append((f, there[f]))
                own = (3, 5, 6)[there[f]]  # the digit that points into the face from its corner i, j or k
                cells[f][tuple(_CORNERS[there[f]] + 3)] = cell
                turns[f][tuple(_CORNERS[there[f]] + 3)] = (n - _CORNER.index(own)) % 5
                # Counter-clockwise around the corner is across the edge opposite the corner before.
                f = int(near[f, (there[f] + 1) % 3])
            around[cell] = ring
        else:
            f, z = int(face[cell]), _plane(place[cell])
            cells[f][tuple(place[cell] + 3)] = cell
            for k in range(3):
                # The same cell on the neighbours' lattices, as far as their points can fall into it.
                other = near[f, k]
                there = _nearest(turn[f, k] * z + shift[f, k])
                if np.abs(there).max() <= 3 and cells[other][tuple(there + 3)] < 0:
                    cells[other][tuple(there + 3)] = cell
                    turns[other][tuple(there + 3)] = -_turns(turn[f, k]) % 6
    return cells, turns, face, place, corner, around


def _leading(digits: np.ndarray) -> np.ndarray:
    """The first digit of each row that is not 0, or 0."""
    if not digits.shape[1]:
        return np.zeros(len(digits), np.int64)
    return np.take_along_axis(digits, (digits != 0).argmax(axis=1)[:, None], axis=1)[:, 0]


def _turned_corner(digits: np.ndarray) -> np.ndarray:
    """Digits below a corner's cell one direction on, counter-clockwise; K is passed over."""
    once = _CCW[digits]
    return np.where((_leading(once) == _K)[:, None], _CCW[once], once)


def cells(lat: np.ndarray, lon: np.ndarray, resolution: int) -> np.ndarray:
    """Index of the cell of each point, in degrees; all must be finite."""
    if not 0 <= resolution <= FINEST:
        raise ValueError(f"resolutions are 0 to {FINEST}")
    points = _globe(np.radians(np.asarray(lat, float)), np.radians(np.asarray(lon, float)))
    face = (points @ _frames()[0].T).argmax(axis=1)
    z = _project(points, face) * np.sqrt(7) ** resolution
    if resolution % 2:
        z = z * np.exp(-1j * _TURN)
    ij = _nearest(z)
    digits = np.zeros((len(ij), resolution), np.int64)
    code = np.zeros((3, 3), np.int64)
    for digit, (i, j) in enumerate(_STEP):
        code[i + 1, j + 1] = digit
    for r in range(resolution, 0, -1):
        parent = _coarser(ij, bool(r % 2))
        step = ij - _finer(parent, bool(r % 2))
        digits[:, r - 1] = code[step[:, 0] + 1, step[:, 1] + 1]
        ij = parent
    found, turns, _, _, corner, _ = _base()
    at = face, ij[:, 0] + 3, ij[:, 1] + 3
    base, many = found[at], turns[at]
    on_corner = corner[base]
    if on_corner.any():
        own, n, place = digits[on_corner], many[on_corner], ij[on_corner]
        # What falls into the direction left out belongs to the face beyond; corners on the second axis have it behind them.
        astray, clockwise = _leading(own) == _K, (place == _CORNERS[1]).all(axis=1)
        own = np.where((astray & clockwise)[:, None], _CW[own], np.where((astray & ~clockwise)[:, None], _CCW[own], own))
        for k in range(1, 5):
            own = np.where((n >= k)[:, None], _turned_corner(own), own)
        digits[on_corner] = own
    plain = ~on_corner
    for k in range(1, 6):
        digits = np.where((plain & (many >= k))[:, None], _CCW[digits], digits)
    index = np.full(len(ij), (1 << 59) | (resolution << 52) | ((1 << 45) - 1), np.int64) | (base << 45)
    for r in range(resolution):
        index ^= (7 ^ digits[:, r]) << (3 * (14 - r))
    return index


def names(index: np.ndarray) -> list[str]:
    return [f"{x:x}" for x in index.tolist()]


def _placed(index: int) -> tuple[int, complex, int, bool, list[int]]:
    """Face, point of its plane in units of the cell's resolution, resolution, and whether a corner's cell."""
    resolution, base = index >> 52 & 15, index >> 45 & 127
    digits = np.array([[index >> (3 * (14 - r)) & 7 for r in range(resolution)]], np.int64)
    _, _, face, place, corner, around = _base()
    f, ij = int(face[base]), place[base]
    lead = int(_leading(digits)[0]) if resolution else 0
    if corner[base] and lead:
        # Into the face that the first direction points to, where the cell lies or right beside it.
        f, k = around[base][_CORNER.index(lead)]
        own, ij = (3, 5, 6)[k], _CORNERS[k]
        for _ in range((_CORNER.index(own) - _CORNER.index(lead)) % 5):
            digits = _turned_corner(digits)
    for r in range(resolution):
        ij = _finer(ij, not r % 2) + _STEP[digits[0, r]]
    return f, complex(_plane(ij)), resolution, bool(corner[base] and not lead), [int(base)]


def _scale(resolution: int) -> complex:
    """From a resolution's plane to that of resolution 0."""
    return np.exp(1j * _TURN * (resolution % 2)) / np.sqrt(7) ** resolution


_OUT = -_plane(_CORNERS) / 2  # from the centre to the middle of the edge opposite each corner


def _beyond(z: complex) -> tuple[int, float]:
    """The edge that a point lies furthest beyond, and how far (negative: inside)."""
    far = [(z * w.conjugate()).real / abs(w) - abs(w) for w in _OUT]
    k = int(np.argmax(far))
    return k, far[k]


def _settle(z: complex, face: int) -> tuple[complex, int]:
    """The same point on the face that it lies on."""
    near, turn, shift = _edges()
    for _ in range(4):
        k, far = _beyond(z)
        if far <= _EDGE:
            break
        z, face = complex(turn[face, k] * z + shift[face, k]), int(near[face, k])
    return z, face


def _degrees(points: np.ndarray) -> list[tuple[float, float]]:
    lat, lon = np.degrees(np.arcsin(np.clip(points[:, 2], -1, 1))), np.degrees(np.arctan2(points[:, 1], points[:, 0]))
    return list(zip(lat.tolist(), lon.tolist(), strict=True))


def centre(index: int) -> tuple[float, float]:
    face, z, resolution, _, _ = _placed(index)
    z, face = _settle(z * _scale(resolution), face)
    return _degrees(_lift(np.array([z]), np.array([face])))[0]


def outline(index: int) -> list[tuple[float, float]]:
    """Latitude and longitude of the corners, counter-clockwise; where an edge goes over the icosahedron's, the point there too."""
    face, z, resolution, corner, base = _placed(index)
    scale = _scale(resolution)
    corners: list[tuple[complex, int]] = []
    if corner:
        _, _, _, _, _, around = _base()
        for f, k in around[base[0]]:
            middle, inward = complex(_plane(_CORNERS[k])), complex(-_plane(_CORNERS[k])) / 2
            for n in range(6):
                own = np.exp(1j * np.pi / 6 * (2 * n + 1)) / np.sqrt(3) * scale
                # Of the sector of 60 degrees that the face has, one edge counts.
                if -np.pi / 6 - _EDGE <= np.angle(own / inward) < np.pi / 6 - _EDGE:
                    corners.append((middle + own, f))
    else:
        # First onto the cell's own face, then each corner from there.
        whole, own = z * scale, face
        turned = 1 + 0j
        near, turn, shift = _edges()
        for _ in range(4):
            k, far = _beyond(whole)
            if far <= _EDGE:
                break
            turned *= turn[own, k]
            whole, own = complex(turn[own, k] * whole + shift[own, k]), int(near[own, k])
        for n in range(6):
            corners.append(_settle(whole + turned * scale * np.exp(1j * np.pi / 6 * (2 * n + 1)) / np.sqrt(3), own))
    near, turn, shift = _edges()
    out_z, out_face = [], []
    for (a, f), (b, g) in zip(corners, corners[1:] + corners[:1], strict=True):
        out_z.append(a)
        out_face.append(f)
        if f != g:
            # The end on the start's plane, and where the way to it leaves the face.
            for k in range(3):
                if near[f, k] == g:
                    end = (b - shift[f, k]) / turn[f, k]
                    height = lambda p, w=_OUT[k]: (p * w.conjugate()).real / abs(w) - abs(w)
                    here, there = height(a), height(end)
                    if here < -_EDGE and there > _EDGE:
                        out_z.append(a + (end - a) * here / (here - there))
                        out_face.append(f)
    return _degrees(_lift(np.array(out_z), np.array(out_face)))


def unwrapped(corners: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Longitudes that go on beyond -180 where an outline crosses 180 degrees."""
    lon = [x for _, x in corners]
    return [(y, x - 360 if x > 0 else x) for y, x in corners] if max(lon) - min(lon) > 180 else corners
