import struct

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from moorage.functions import wkb

COORDS = pa.list_(pa.list_(pa.list_(pa.list_(pa.float64()))))
TYPE = pa.struct([("collection", pa.bool_()), ("members", pa.list_(pa.struct([("kind", pa.int32()), ("coords", COORDS)])))])


def one(kind, coords):
    return {"collection": False, "members": [{"kind": kind, "coords": coords}]}


def run(*geometries):
    return wkb.encode(pa.array(list(geometries), TYPE)).to_pylist()


def plain(kind, coords, z=False):
    """Straightforward one-geometry writer to compare with."""
    code = kind | (0x80000000 if z else 0)
    head = struct.pack("<BI", 1, code)
    pts = lambda ring: b"".join(struct.pack(f"<{len(p)}d", *p) for p in ring)
    poly = lambda rings: struct.pack("<I", len(rings)) + b"".join(struct.pack("<I", len(r)) + pts(r) for r in rings)
    if kind == 1:
        return head + pts(coords[0][0])
    if kind == 2:
        return head + struct.pack("<I", len(coords[0][0])) + pts(coords[0][0])
    if kind == 3:
        return head + poly(coords[0])
    if kind == 4:
        points = coords[0][0]
        return head + struct.pack("<I", len(points)) + b"".join(plain(1, [[[p]]], z) for p in points)
    if kind == 5:
        lines = coords[0]
        return head + struct.pack("<I", len(lines)) + b"".join(plain(2, [[line]], z) for line in lines)
    return head + struct.pack("<I", len(coords)) + b"".join(plain(3, [rings], z) for rings in coords)


def test_known_bytes():
    (point,) = run(one(1, [[[[1.0, 2.0]]]]))
    assert point["wkb"].hex().upper() == "0101000000000000000000F03F0000000000000040"
    (point,) = run(one(1, [[[[1.0, 2.0, 3.0]]]]))
    assert point["wkb"].hex().upper() == "0101000080000000000000F03F00000000000000400000000000000840"
    assert wkb.iso_form(point["wkb"]).hex()[:10] == "01e9030000"


def test_rings_are_closed_and_holes_kept():
    open_ring, hole = [[0, 0], [4, 0], [4, 4], [0, 4]], [[1, 1], [2, 1], [2, 2]]
    (got,) = run(one(3, [[open_ring, hole]]))
    assert got["wkb"] == plain(3, [[open_ring + [[0, 0]], hole + [[1, 1]]]])


@pytest.mark.parametrize(
    "geometry, message",
    [
        (one(3, [[[[0, 0], [1, 0]]]]), "ring has fewer than 4 points"),
        (one(2, [[[[0, 0]]]]), "line has one point"),
        (one(2, [[[[0, 0], [1, 1, 1]]]]), "mixed coordinate dimensions"),
        (one(1, [[[[0]]]]), "coordinates must have 2 or 3 dimensions"),
        (one(2, [[[[0, None], [1, 1]]]]), "missing ordinate"),
        (one(5, [[[[0, 0], [1, 1]], []]]), "empty part"),
        (one(0, None), "unsupported geometry type"),
    ],
)
def test_failures_are_null_with_a_reason(geometry, message):
    (got,) = run(geometry)
    assert got == {"wkb": None, "error": message}


def test_empty_geometries_are_null_without_error():
    assert run(None, one(3, []), one(3, None), one(2, [[[]]]), {"collection": True, "members": []}) == [
        {"wkb": None, "error": None}
    ] * 5
    assert run(one(1, [[[[]]]]), one(4, [[[[], []]]]), one(6, [[[[]]], [[]]])) == [{"wkb": None, "error": None}] * 3
    (got,) = run({"collection": True, "members": [{"kind": 3, "coords": [[[]]]}, {"kind": 4, "coords": [[[[]]]]}, {"kind": 2, "coords": [[[[1, 2], [3, 4]]]]}]})
    hollow = struct.pack("<BII", 1, 3, 0) + struct.pack("<BII", 1, 4, 0)
    assert got["wkb"] == struct.pack("<BII", 1, 7, 3) + hollow + plain(2, [[[[1, 2], [3, 4]]]])



def test_collection():
    (got,) = run({"collection": True, "members": [{"kind": 1, "coords": [[[[9, 8]]]]}, {"kind": 2, "coords": [[[[1, 2], [3, 4]]]]}]})
    want = struct.pack("<BII", 1, 7, 2) + plain(1, [[[[9, 8]]]]) + plain(2, [[[[1, 2], [3, 4]]]])
    assert got["wkb"] == want
    assert wkb.bounds(want) == ("GeometryCollection", 1.0, 2.0, 9.0, 8.0)


ordinate = st.floats(-1e6, 1e6, allow_nan=False)


@st.composite
def geometries(draw):
    z = draw(st.booleans())
    point = st.lists(ordinate, min_size=2 + z, max_size=2 + z)
    line = st.lists(point, min_size=2, max_size=5)
    ring = st.lists(point, min_size=4, max_size=6).map(lambda r: r + [r[0]])
    kind = draw(st.integers(1, 6))
    coords = draw(
        {
            1: point.map(lambda p: [[[p]]]),
            2: line.map(lambda r: [[r]]),
            3: st.lists(ring, min_size=1, max_size=3).map(lambda r: [r]),
            4: st.lists(point, min_size=1, max_size=4).map(lambda p: [[p]]),
            5: st.lists(line, min_size=1, max_size=3).map(lambda r: [r]),
            6: st.lists(st.lists(ring, min_size=1, max_size=2), min_size=1, max_size=3),
        }[kind]
    )
    return kind, coords, z


@settings(max_examples=150, deadline=None)
@given(st.lists(geometries(), max_size=6))
def test_batches_equal_plain_writer_and_decode_back(items):
    got = run(*[one(k, c) for k, c, _ in items])
    for (kind, coords, z), row in zip(items, got):
        first = [r if r[0] == r[-1] or kind not in (3, 6) else r for p in coords for r in p]
        assert first is not None and row["error"] is None
        assert row["wkb"] == plain(kind, coords, z)
        assert wkb.decode(row["wkb"]) == one(kind, coords)
        assert wkb.decode(wkb.iso_form(row["wkb"])) == one(kind, coords)


def test_big_endian_srid_and_garbage():
    big = struct.pack(">BIdd", 0, 1, 5.0, 6.0)
    assert wkb.decode(big) == one(1, [[[[5.0, 6.0]]]])
    srid = struct.pack("<BIIdd", 1, 1 | 0x20000000, 4326, 5.0, 6.0)
    assert wkb.decode(srid) == one(1, [[[[5.0, 6.0]]]])
    assert wkb.iso_form(srid) == struct.pack("<BIdd", 1, 1, 5.0, 6.0)
    for bad in (b"", b"\x01", b"\x01\x63\x00\x00\x00", big[:-1], big + b"x"):
        with pytest.raises(ValueError):
            wkb.decode(bad)


def test_sliced_batches():
    rows = [one(1, [[[[i, i]]]]) for i in range(6)]
    arr = pa.array(rows, TYPE)
    assert wkb.encode(arr.slice(2, 3)).to_pylist() == wkb.encode(arr).to_pylist()[2:5]
    assert len(wkb.encode(arr.slice(0, 0))) == 0


def some(kind, coords, z, order="<", srid=None, iso=False):
    """A blob in any of the forms that are read."""
    code = kind + (1000 if iso and z else 0) | (0x80000000 if z and not iso else 0) | (0x20000000 if srid else 0)
    head = struct.pack(order + "BI", order == "<", code) + (struct.pack(order + "I", srid) if srid else b"")
    count = lambda n: struct.pack(order + "I", n)
    pts = lambda ring: b"".join(struct.pack(f"{order}{len(p)}d", *p) for p in ring)
    poly = lambda rings: count(len(rings)) + b"".join(count(len(r)) + pts(r) for r in rings)
    inner = {4: (1, [[[p]] for p in coords[0][0]] if kind == 4 else []), 5: (2, [[[r]] for r in coords[0]]), 6: (3, [[p] for p in coords])}
    if kind in inner:
        part, own = inner[kind]
        own = [[c[0]] if kind == 4 else c for c in own]
        return head + count(len(own)) + b"".join(some(part, [c] if kind == 4 else c, z, order, None, iso) for c in own)
    return head + {1: lambda: pts(coords[0][0]), 2: lambda: count(len(coords[0][0])) + pts(coords[0][0]), 3: lambda: poly(coords[0])}[kind]()


def box_of(kind, coords, z):
    points = [p for polygon in coords for ring in polygon for p in ring]
    name = wkb.KIND_NAMES[kind] + (" Z" if z else "")
    sides = [f(p[i] for p in points) for f in (min, max) for i in (0, 1)]
    return dict(zip(["geometry_type", "xmin", "ymin", "xmax", "ymax"], [name, *sides]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(geometries(), st.sampled_from("<>"), st.sampled_from([None, 4326]), st.booleans(), st.sampled_from("gggnb")), max_size=8), st.integers(0, 3))
def test_batches_of_any_form(items, skip):
    blobs, shapes, boxes, plainer = [], [], [], []
    for (kind, coords, z), order, srid, iso, state in items:
        blob = some(kind, coords, z, order, srid, iso)
        blobs.append({"g": blob, "n": None, "b": blob[:-1]}[state])
        shapes.append(one(kind, coords) if state == "g" else None)
        boxes.append(box_of(kind, coords, z) if state == "g" else None)
        plainer.append(some(kind, coords, z, order, None, True) if state == "g" else None)
    arr = pa.array([b"x", *blobs], pa.binary()).slice(1).slice(skip)
    parts = wkb.Parts(arr)
    assert wkb.geometries_of(parts).to_pylist() == shapes[skip:]
    assert wkb.bounds_of(parts).to_pylist() == boxes[skip:]
    broken = [state == "b" for *_, state in items][skip:]
    assert [e is not None for e in parts.problems().to_pylist()] == broken
    if not any(broken):
        assert wkb.iso_of(parts).to_pylist() == plainer[skip:]


def test_parts_without_points_and_missing_ordinates():
    nan = float("nan")
    hollow = [struct.pack("<BII", 1, k, 0) for k in (2, 3, 4, 5, 6, 7)]
    gone = struct.pack("<BIdd", 1, 1, nan, nan)
    half = struct.pack("<BII", 1, 4, 2) + gone + struct.pack("<BIdd", 1, 1, 3.0, 4.0)
    parts = wkb.Parts(pa.array([*hollow, gone, half, None], pa.binary()))
    boxes = wkb.bounds_of(parts).to_pylist()
    assert [b and b["xmin"] for b in boxes] == [None] * 7 + [3.0, None] and boxes[-1] is None and boxes[0]["geometry_type"] == "LineString"
    shapes = wkb.geometries_of(parts).to_pylist()
    assert [s["members"][0]["coords"] for s in shapes[:5]] == [[[[]]], [[]], [[]], [[]], []] and shapes[5] == {"collection": True, "members": []}


def test_nested_collections_and_far_too_many_parts():
    point = struct.pack("<BIdd", 1, 1, 1.0, 2.0)
    nested = struct.pack("<BII", 1, 7, 2) + struct.pack("<BII", 1, 7, 1) + point + point
    assert wkb.bounds(nested) == ("GeometryCollection", 1.0, 2.0, 1.0, 2.0)
    with pytest.raises(ValueError, match="collection inside"):
        wkb.decode(nested)
    for blob in (struct.pack("<BII", 1, 6, 4_000_000_000), struct.pack("<BII", 1, 7, 1) * 60 + point, struct.pack("<BII", 1, 3, 1) + struct.pack("<I", 4_000_000_000)):
        with pytest.raises(ValueError):
            wkb.bounds(blob)
    assert len(wkb.geometries_of(wkb.Parts(pa.array([], pa.binary())))) == 0
    assert wkb.bounds_of(wkb.Parts(pa.array([None, None], pa.binary()))).to_pylist() == [None, None]


def test_hexadecimal_texts():
    assert wkb.from_hex(pa.array(["0aFf", None, "", "00", "x"]).slice(0, 4)).to_pylist() == [b"\x0a\xff", None, None, b"\x00"]
    assert wkb.from_hex(pa.array(["zz", "0102"]).slice(1)).to_pylist() == [b"\x01\x02"]
    for bad in ("0", "0g", "00 "):
        with pytest.raises(ValueError):
            wkb.from_hex(pa.array([bad]))
