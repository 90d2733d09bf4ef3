"""Batch conversion between coordinate arrays and well-known binary.

On the Spark side a geometry is ``GEOMETRY``: its member geometries (exactly one unless it is a
collection), each with a kind and coordinates nested as polygons > rings > points > ordinates.
Shallower kinds use one-element outer levels. The functions work on whole Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql import types as T

COORDS = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
MEMBER = T.StructType().add("kind", T.IntegerType()).add("coords", COORDS)
GEOMETRY = T.StructType().add("collection", T.BooleanType()).add("members", T.ArrayType(MEMBER))
BOUNDS = T.StructType().add("geometry_type", T.StringType())
for _side in ("xmin", "ymin", "xmax", "ymax"):
    BOUNDS = BOUNDS.add(_side, T.DoubleType())

# WKB geometry codes and flags.
POINT, LINE, POLYGON, MULTI_POINT, MULTI_LINE, MULTI_POLYGON, COLLECTION = range(1, 8)
KIND_NAMES = {
    POINT: "Point",
    LINE: "LineString",
    POLYGON: "Polygon",
    MULTI_POINT: "MultiPoint",
    MULTI_LINE: "MultiLineString",
    MULTI_POLYGON: "MultiPolygon",
    COLLECTION: "GeometryCollection",
}
Z_FLAG, M_FLAG, SRID_FLAG = 0x80000000, 0x40000000, 0x20000000


def _level(arr: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Zero-based offsets and children of one list level; null lists count as empty."""
    lengths = arr.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), arr.flatten()


def _owner(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def _total(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the child values of each parent."""
    running = np.concatenate([[0], np.cumsum(values)])
    return running[offsets[1:]] - running[offsets[:-1]]


def _place(start: np.ndarray, prefix: np.ndarray, size: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First byte of every child, given where its parent starts."""
    running = np.concatenate([[0], np.cumsum(size)])
    owner = _owner(offsets)
    return (start + prefix)[owner] + running[:-1] - running[offsets[:-1]][owner]


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    if not len(at):
        return
    data = np.ascontiguousarray(values).view(np.uint8).reshape(len(at), -1)
    out[at[:, None] + np.arange(data.shape[1])] = data


def _put_header(out: np.ndarray, at: np.ndarray, code: np.ndarray, count: np.ndarray | None) -> None:
    out[at] = 1
    _put(out, at + 1, code.astype("<u4"))
    if count is not None:
        _put(out, at + 5, count.astype("<u4"))


def _flag(bad: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Parents that own at least one bad child."""
    return np.bincount(owner[bad], minlength=n).astype(bool)


def encode(geometries: pa.Array) -> pa.Array:
    """``struct<wkb: binary, error: string>`` per geometry.

    A geometry without points gives null without an error. Rings are closed; rings under four
    points, one-point lines, empty parts and mixed or odd dimensions give null with an error.
    """
    rows = len(geometries)
    collection = geometries.field("collection").fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
    # Children of null structs must not be read.
    members_col = pa.compute.if_else(geometries.is_valid(), geometries.field("members"), None)
    m_off, members = _level(members_col)
    kind = members.field("kind").fill_null(0).to_numpy(zero_copy_only=False)
    p_off, polys = _level(members.field("coords"))
    r_off, rings = _level(polys)
    c_off, points = _level(rings)
    o_off, ordinates = _level(points)
    values = ordinates.to_numpy(zero_copy_only=False).astype("f8")
    n_m = len(kind)
    member_of_poly, poly_of_ring, ring_of_point = _owner(p_off), _owner(r_off), _owner(c_off)
    member_of_ring = member_of_poly[poly_of_ring]
    member_of_point = member_of_ring[ring_of_point]
    row_of_member = _owner(m_off)
    widths = np.diff(o_off)

    errors = np.full(n_m, None, dtype=object)

    def fail(mask: np.ndarray, message: str) -> None:
        errors[mask & np.equal(errors, None)] = message

    empty = np.bincount(member_of_point, weights=widths, minlength=n_m) == 0
    dims = np.zeros(n_m, dtype=np.int64)
    np.maximum.at(dims, member_of_point, widths)
    fail(_flag(widths != dims[member_of_point], member_of_point, n_m), "mixed coordinate dimensions")
    fail(~empty & (dims != 2) & (dims != 3), "coordinates must have 2 or 3 dimensions")
    fail(_flag(np.isnan(values), member_of_point[_owner(o_off)], n_m), "missing ordinate")
    good_point = errors[member_of_point] == None  # noqa: E711 - elementwise
    xyz = np.zeros((len(widths), 3))
    first = o_off[:-1]
    for axis in range(3):
        use = good_point & (widths > axis)
        xyz[use, axis] = values[first[use] + axis]

    # Close rings of polygons.
    ring_kind = kind[member_of_ring]
    ring_size = np.diff(c_off)
    is_ring = (ring_kind == POLYGON) | (ring_kind == MULTI_POLYGON)
    full = np.flatnonzero(ring_size > 0)
    needs = np.zeros(len(ring_size), dtype=bool)
    needs[full] = is_ring[full] & (
        (ring_size[full] == 3) | (xyz[c_off[full]] != xyz[c_off[full + 1] - 1]).any(axis=1)
    )
    source = np.insert(np.arange(len(xyz)), c_off[1:][needs], c_off[:-1][needs])
    ring_size = ring_size + needs
    c_off = np.concatenate([[0], np.cumsum(ring_size)])
    xyz, ring_of_point = xyz[source], _owner(c_off)
    member_of_point = member_of_ring[ring_of_point]

    in_multi = np.isin(ring_kind, (MULTI_LINE, MULTI_POLYGON)) | is_ring
    fail(_flag((ring_size == 0) & in_multi, member_of_ring, n_m) & ~empty, "empty part")
    fail(_flag(is_ring & (ring_size > 0) & (ring_size < 4), member_of_ring, n_m) & ~empty, "ring has fewer than 4 points")
    lines = (ring_kind == LINE) | (ring_kind == MULTI_LINE)
    fail(_flag(lines & (ring_size == 1), member_of_ring, n_m) & ~empty, "line has one point")
    fail((kind < POINT) | (kind > MULTI_POLYGON), "unsupported geometry type")

    bad_row = _flag(np.not_equal(errors, None), row_of_member, rows)
    has_points = np.bincount(row_of_member[~empty], minlength=rows) > 0
    keep_row = ~bad_row & has_points
    keep_m = keep_row[row_of_member]

    # Sizes from the inside out; dropped rows take no bytes.
    full_m = keep_m & ~empty
    keep_pt, keep_r, keep_p = full_m[member_of_point], full_m[member_of_ring], full_m[member_of_poly]
    pt_kind, poly_kind = kind[member_of_point], kind[member_of_poly]
    dim_pt = dims[member_of_point]
    pt_prefix = np.where(pt_kind == MULTI_POINT, 5, 0)
    pt_size = np.where(keep_pt, pt_prefix + 8 * dim_pt, 0)
    ring_prefix = np.where(is_ring, 4, np.where(ring_kind == MULTI_LINE, 9, 0)) * keep_r
    ring_bytes = ring_prefix + _total(pt_size, c_off)
    poly_prefix = np.where(poly_kind == MULTI_POLYGON, 9, 0) * keep_p
    poly_bytes = poly_prefix + _total(ring_bytes, r_off)
    member_prefix = np.where(kind == POINT, 5, 9) * keep_m
    # An empty point inside a collection is written as NaN ordinates.
    hollow = keep_m & empty & (kind == POINT)
    member_bytes = member_prefix + _total(poly_bytes, p_off) + 16 * hollow
    row_prefix = np.where(collection, 9, 0) * keep_row
    row_bytes = row_prefix + _total(member_bytes, m_off)

    row_start = np.concatenate([[0], np.cumsum(row_bytes)])
    member_at = _place(row_start[:-1], row_prefix, member_bytes, m_off)
    poly_at = _place(member_at, member_prefix, poly_bytes, p_off)
    ring_at = _place(poly_at, poly_prefix, ring_bytes, r_off)
    pt_at = _place(ring_at, ring_prefix, pt_size, c_off)

    out = np.zeros(int(row_start[-1]), dtype=np.uint8)
    z = np.where(dims == 3, Z_FLAG, 0)
    row_z = np.where(_flag(dims == 3, row_of_member, rows), Z_FLAG, 0)
    pick = keep_row & collection
    _put_header(out, row_start[:-1][pick], COLLECTION | row_z[pick], np.diff(m_off)[pick])
    pick = keep_m & (kind == POINT)
    _put_header(out, member_at[pick], (POINT | z)[pick], None)
    _put(out, member_at[hollow] + 5, np.full((int(hollow.sum()), 2), np.nan, dtype="<f8"))
    pick = keep_m & (kind != POINT)
    parts = np.select(
        [kind == POLYGON, kind == MULTI_LINE, kind == MULTI_POLYGON],
        [np.bincount(member_of_ring, minlength=n_m)] * 2 + [np.diff(p_off)],
        np.bincount(member_of_point, minlength=n_m),
    )
    parts = np.where(empty, 0, parts)
    _put_header(out, member_at[pick], (kind | z)[pick], parts[pick])
    pick = keep_p & (poly_kind == MULTI_POLYGON)
    _put_header(out, poly_at[pick], POLYGON | z[member_of_poly[pick]], np.diff(r_off)[pick])
    pick = keep_r & is_ring
    _put(out, ring_at[pick], ring_size[pick].astype("<u4"))
    pick = keep_r & (ring_kind == MULTI_LINE)
    _put_header(out, ring_at[pick], LINE | z[member_of_ring[pick]], ring_size[pick])
    pick = keep_pt & (pt_kind == MULTI_POINT)
    _put_header(out, pt_at[pick], POINT | z[member_of_point[pick]], None)
    for dim in (2, 3):
        pick = keep_pt & (dim_pt == dim)
        _put(out, (pt_at + pt_prefix)[pick], xyz[pick, :dim].astype("<f8"))

    message = np.full(rows, None, dtype=object)
    broken = np.flatnonzero(np.not_equal(errors, None))[::-1]
    message[row_of_member[broken]] = errors[broken]
    validity = pa.array(keep_row)
    wkb = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), rows, [validity.buffers()[1], pa.py_buffer(row_start.astype("<i8")), pa.py_buffer(out)]
    ).cast(pa.binary())
    return pa.StructArray.from_arrays([wkb, pa.array(message, pa.string())], ["wkb", "error"])


# Deepest nesting of parts that is read, and the bytes of a coordinate.
_DEEPEST, _WIDE = 32, 8


class Parts:
    """The parts of a batch of WKB blobs, found for all blobs at once, part by part.

    Every blob has a cursor and a stack of parts still to come; a step reads the next part of each blob that has one. So
    there are as many steps as the blob of most parts has, each over arrays. Headers and coordinate runs are rows, in the
    order of their blobs and places: ``blob, kind (0: a ring), depth, at (the header's or first coordinate's byte), count,
    dims, little, srid``. Plain, Z and SRID forms of both byte orders are read. ``errors`` has a text for malformed blobs,
    whose rows are left out; nulls have neither.
    """

    def __init__(self, blobs: pa.Array):
        blobs = blobs.cast(pa.large_binary())
        n = len(blobs)
        offsets = np.frombuffer(blobs.buffers()[1], "<i8")[blobs.offset : blobs.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = blobs.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.start, self.stop = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        self.valid = blobs.is_valid().to_numpy(zero_copy_only=False)
        self.errors: dict[int, str] = {}
        # Reads beyond a blob stay inside the array; they are refused afterwards.
        self._padded = np.concatenate([self.data, np.zeros(16, np.uint8)])
        self._walk(n)

    def _numbers(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        """Unsigned 32-bit integers at the given places."""
        at = np.minimum(at, len(self.data))
        four = self._padded[at[:, None] + np.arange(4)].astype(np.int64)
        return np.where(little, four @ (1 << np.arange(0, 32, 8)), four @ (1 << np.arange(24, -8, -8)))

    def _refuse(self, blobs: np.ndarray, reasons: list[str] | str) -> None:
        texts = [reasons] * len(blobs) if isinstance(reasons, str) else reasons
        self.errors.update(zip(blobs.tolist(), texts))

    def _walk(self, n: int) -> None:
        pos, depth = self.start.copy(), np.zeros(n, np.int64)
        todo, rings = np.zeros((n, _DEEPEST + 1), np.int64), np.zeros((n, _DEEPEST + 1), bool)
        little_at, dims_at = np.zeros((n, _DEEPEST + 1), bool), np.zeros((n, _DEEPEST + 1), np.int64)
        todo[:, 0] = 1
        active = np.flatnonzero(self.valid)
        steps: list[tuple[np.ndarray, ...]] = []
        while len(active):
            # Back to the innermost level that has parts left.
            while len(empty := active[todo[active, depth[active]] == 0]):
                depth[empty] -= 1
                done = empty[depth[empty] < 0]
                if len(done):
                    self._refuse(done[pos[done] != self.stop[done]], "trailing bytes after geometry")
                    active = active[depth[active] >= 0]
            if not len(active):
                break
            level = depth[active]
            todo[active, level] -= 1
            is_ring = rings[active, level]
            refused = []

            own, deep = active[is_ring], level[is_ring]
            if len(own):
                little, dims = little_at[own, deep], dims_at[own, deep]
                count, first = self._numbers(pos[own], little), pos[own] + 4
                pos[own] = first + _WIDE * dims * count
                refused.append(own[pos[own] > self.stop[own]])
                steps.append((own, np.zeros(len(own), np.int64), deep, first, count, dims, little, np.zeros(len(own), bool)))

            own, deep = active[~is_ring], level[~is_ring]
            if len(own):
                head = pos[own]
                little = self._padded[np.minimum(head, len(self.data))] == 1
                code = self._numbers(head + 1, little)
                srid = (code & SRID_FLAG) != 0
                base = code & 0xFFFF
                iso = base // 1000
                kind = np.where(base >= 1000, base % 1000, base)
                has_z = np.where(base >= 1000, (iso == 1) | (iso == 3), (code & Z_FLAG) != 0)
                unknown = ((code & M_FLAG) != 0) | (kind < POINT) | (kind > COLLECTION) | (base >= 2000)
                short = head + 5 > self.stop[own]
                self._refuse(own[unknown & ~short], [f"unsupported WKB code {c}" for c in code[unknown & ~short].tolist()])
                refused.append(own[unknown | short])
                dims = np.where(has_z, 3, 2)
                at = head + 5 + 4 * srid
                point = kind == POINT
                count = np.where(point, 1, self._numbers(at, little))
                at = at + np.where(point, 0, 4)
                line = point | (kind == LINE)
                pos[own] = at + np.where(line, _WIDE * dims * count, 0)
                refused.append(own[pos[own] > self.stop[own]])
                steps.append((own, kind, deep, head, np.where(line, 0, count), dims, little, srid))
                # The coordinates of points and lines are rows like rings.
                steps.append((own[line], np.zeros(line.sum(), np.int64), deep[line] + 1, at[line], count[line], dims[line], little[line], srid[line]))
                inner, below = own[~line], deep[~line] + 1
                deep_down = below > _DEEPEST
                self._refuse(inner[deep_down], "nested too deeply")
                refused.append(inner[deep_down])
                inner, below, where = inner[~deep_down], below[~deep_down], np.flatnonzero(~line)[~deep_down]
                depth[inner] = below
                todo[inner, below] = count[where]
                rings[inner, below] = kind[where] == POLYGON
                little_at[inner, below], dims_at[inner, below] = little[where], dims[where]
            gone = np.unique(np.concatenate(refused)) if refused else active[:0]
            if len(gone):
                self._refuse(np.array([b for b in gone.tolist() if b not in self.errors], np.int64), "truncated WKB")
                active = np.setdiff1d(active, gone, assume_unique=True)
        columns = [np.concatenate([s[k] for s in steps]) if steps else np.zeros(0, np.int64) for k in range(8)]
        turn = np.repeat(np.arange(len(steps)), [len(s[0]) for s in steps])
        bad = np.isin(columns[0], np.fromiter(self.errors, np.int64, len(self.errors)))
        order = np.lexsort((turn, columns[0]))
        order = order[~bad[order]]
        self.blob, self.kind, self.depth, self.at, self.count, self.dims, little, srid = (c[order] for c in columns)
        self.little, self.srid = little.astype(bool), srid.astype(bool)
        self.is_run = self.kind == 0

    def coordinates(self) -> np.ndarray:
        """The ordinates of all coordinate runs, one after another."""
        run = self.is_run
        many = (self.count * self.dims)[run]
        first = np.concatenate([[0], np.cumsum(many)])
        place = np.repeat(self.at[run], many) + _WIDE * (np.arange(first[-1]) - np.repeat(first[:-1], many))
        out = np.empty(len(place), "<f8")
        # Eight views of the bytes, one for each way a coordinate can lie across words.
        for shift in range(_WIDE):
            own = np.flatnonzero(place % _WIDE == shift)
            if len(own):
                whole = (len(self._padded) - shift) // _WIDE * _WIDE
                out[own] = self._padded[shift : shift + whole].view("<f8")[place[own] // _WIDE]
        big = np.repeat(~self.little[run], many)
        if big.any():
            out[big] = out[big].byteswap()
        return out

    def extended(self) -> bool:
        """Whether any blob has a Z or an SRID, which other forms write differently."""
        return bool((self.srid | (self.dims == 3)).any())

    def problems(self) -> pa.Array:
        return pa.array([self.errors.get(i) for i in range(len(self.valid))] if self.errors else [None] * len(self.valid), pa.string())


def bounds_of(parts: Parts, values: np.ndarray | None = None) -> pa.StructArray:
    """``BOUNDS`` of each blob: its type and the x/y range of its parts without missing ordinates; null where it has none."""
    n = len(parts.valid)
    values = parts.coordinates() if values is None else values
    top = np.flatnonzero(~parts.is_run & (parts.depth == 0))
    names = np.full(n, None, object)
    kinds, flat = parts.kind[top], parts.dims[top] == 2
    for kind, name in KIND_NAMES.items():
        names[parts.blob[top[(kinds == kind) & flat]]] = name
        names[parts.blob[top[(kinds == kind) & ~flat]]] = name + " Z"
    box = np.full((4, n), np.nan)
    runs = np.flatnonzero(parts.is_run)
    runs_many, dims = parts.count[runs], parts.dims[runs]
    first = np.concatenate([[0], np.cumsum(runs_many * dims)])[:-1]
    some = runs_many > 0
    if some.any():
        owner = np.repeat(np.arange(len(runs)), runs_many)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(runs_many) - runs_many, runs_many)
        x = first[owner] + within * dims[owner]
        edges = np.concatenate([[0], np.cumsum(runs_many[some])])[:-1]
        xs, ys = values[x], values[x + 1]
        sides = [np.minimum.reduceat(xs, edges), np.minimum.reduceat(ys, edges), np.maximum.reduceat(xs, edges), np.maximum.reduceat(ys, edges)]
        whole = ~np.isnan(sides[0] + sides[1])
        blob = parts.blob[runs[some]][whole]
        if len(blob):
            starts = np.flatnonzero(np.concatenate([[True], blob[1:] != blob[:-1]]))
            for k, side in enumerate(sides):
                fold = np.minimum if k < 2 else np.maximum
                box[k, blob[starts]] = fold.reduceat(side[whole], starts)
    columns = [pa.array(names, pa.string()), *(pa.array(side, mask=np.isnan(side)) for side in box)]
    there = np.array([v is not None for v in names], bool) if n else np.zeros(0, bool)
    return pa.StructArray.from_arrays(columns, [f.name for f in BOUNDS], mask=pa.array(~there))


def geometries_of(parts: Parts, values: np.ndarray | None = None) -> pa.StructArray:
    """``GEOMETRY`` of each blob, null where it is null or malformed; collections inside collections are malformed."""
    n = len(parts.valid)
    head = ~parts.is_run
    collection = np.zeros(n, bool)
    collection[parts.blob[head & (parts.kind == COLLECTION) & (parts.depth == 0)]] = True
    nested = np.unique(parts.blob[head & (parts.kind == COLLECTION) & (parts.depth > 0)])
    parts._refuse(nested, "collection inside a collection")
    values = parts.coordinates() if values is None else values
    good = ~np.isin(parts.blob, nested)
    kept = np.repeat(good[parts.is_run], (parts.count * parts.dims)[parts.is_run])
    values = values[kept]
    blob, kind, depth, count, dims, is_run = (a[good] for a in (parts.blob, parts.kind, parts.depth, parts.count, parts.dims, parts.is_run))
    member = ~is_run & (kind != COLLECTION) & (depth == collection[blob])
    member_of = np.cumsum(member) - 1
    kinds = kind[member]
    top = kinds[member_of] if len(kinds) else kind[:0]
    # A member is one polygon, a multi-polygon one for each of its parts.
    polygon = np.where(top == MULTI_POLYGON, ~is_run & (kind == POLYGON), member) if len(kinds) else member
    polygon_of = np.cumsum(polygon) - 1
    # The points of a multi-point share one ring.
    previous = np.concatenate([[-1], member_of[is_run][:-1]]) if is_run.any() else member_of[:0]
    new = (top[is_run] != MULTI_POINT) | (member_of[is_run] != previous)
    ring_of = np.cumsum(new) - 1
    points = np.bincount(ring_of, count[is_run], int(new.sum())).astype(np.int64) if is_run.any() else np.zeros(0, np.int64)

    def lists(sizes: np.ndarray, of: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), of)

    coords = lists(np.repeat(dims[is_run], count[is_run]), pa.array(values))
    coords = lists(points, coords)
    coords = lists(np.bincount(polygon_of[is_run][new], minlength=int(polygon.sum())) if is_run.any() else np.zeros(int(polygon.sum()), np.int64), coords)
    coords = lists(np.bincount(member_of[polygon], minlength=len(kinds)), coords)
    members = pa.StructArray.from_arrays([pa.array(kinds, pa.int32()), coords], ["kind", "coords"])
    members = lists(np.bincount(blob[member], minlength=n), members)
    missing = ~parts.valid.copy()
    missing[np.fromiter(parts.errors, np.int64, len(parts.errors))] = True
    return pa.StructArray.from_arrays([pa.array(collection), members], ["collection", "members"], mask=pa.array(missing))


def iso_of(parts: Parts) -> pa.Array:
    """The same geometries with ISO dimension codes and no SRID, as GeoParquet requires."""
    head = ~parts.is_run
    out, keep = parts.data.copy(), np.ones(len(parts.data), bool)
    code = parts.kind[head] + np.where(parts.dims[head] == 3, 1000, 0)
    shifts = np.where(parts.little[head, None], np.arange(0, 32, 8), np.arange(24, -8, -8))
    out[(parts.at[head] + 1)[:, None] + np.arange(4)] = (code[:, None] >> shifts) & 0xFF
    srid = parts.at[head][parts.srid[head]]
    keep[(srid[:, None] + np.arange(5, 9)).reshape(-1)] = False
    kept = np.concatenate([[0], np.cumsum(keep)])
    offsets = np.append(kept[parts.start], kept[parts.stop[-1:]]).astype("<i8")
    mask = pa.array(parts.valid).buffers()[1]
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(parts.valid), [mask, pa.py_buffer(offsets), pa.py_buffer(out[keep])])
    return whole.cast(pa.binary())


def _single(blob: bytes) -> Parts:
    parts = Parts(pa.array([blob], pa.binary()))
    _raise(parts)
    return parts


def _raise(parts: Parts) -> None:
    if parts.errors:
        raise ValueError(parts.errors[min(parts.errors)])


def decode(blob: bytes) -> dict:
    """``GEOMETRY`` value of one WKB blob; ValueError on malformed input."""
    parts = _single(blob)
    found = geometries_of(parts)
    _raise(parts)
    return found[0].as_py()


def iso_form(blob: bytes) -> bytes:
    return iso_of(_single(blob))[0].as_py()


def bounds(blob: bytes) -> tuple[str, float, float, float, float]:
    """Geometry type name and x/y range of one blob."""
    return tuple(bounds_of(_single(blob))[0].as_py().values())


_NIBBLE = np.full(256, 255, np.uint8)
for _digits in (b"0123456789abcdef", b"0123456789ABCDEF"):
    _NIBBLE[np.frombuffer(_digits, np.uint8)] = np.arange(16)


def from_hex(texts: pa.Array) -> pa.Array:
    """Bytes of hexadecimal texts; null and empty ones are null. ValueError if one is not hexadecimal."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return pa.array([], pa.binary())
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    digits = _NIBBLE[np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    if (lengths % 2).any() or (digits > 15).any():
        raise ValueError("not hexadecimal")
    data = digits[0::2] << 4 | digits[1::2]
    mask = pa.array(lengths > 0).buffers()[1]
    places = ((offsets - offsets[0]) // 2).astype("<i8")
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [mask, pa.py_buffer(places), pa.py_buffer(data)])
    return whole.cast(pa.binary())


@F.arrow_udf(T.StructType().add("wkb", T.BinaryType()).add("error", T.StringType()))
def encode_wkb(geometries: pa.Array) -> pa.Array:
    return encode(geometries)


@F.arrow_udf(T.StructType().add("geometry", GEOMETRY).add("error", T.StringType()))
def decode_wkb(blobs: pa.Array) -> pa.Array:
    parts = Parts(blobs)
    geometry = geometries_of(parts)
    return pa.StructArray.from_arrays([geometry, parts.problems()], ["geometry", "error"])


@F.arrow_udf(T.StructType().add("box", BOUNDS).add("error", T.StringType()))
def wkb_bounds(blobs: pa.Array) -> pa.Array:
    parts = Parts(blobs)
    return pa.StructArray.from_arrays([bounds_of(parts), parts.problems()], ["box", "error"])


# So declared, a filter on a result is not moved below the call, where it would call it again.
encode_wkb = encode_wkb.asNondeterministic()
decode_wkb = decode_wkb.asNondeterministic()
wkb_bounds = wkb_bounds.asNondeterministic()
