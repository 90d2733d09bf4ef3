"""Delimited records over several lines, whatever the ranges they are read in."""

import csv
import gzip
import io
import random

import pytest

from moorage.plans import file_load
from moorage.sources import delimited, records

VALUES = ["plain", "two\nlines", 'q"uote', "a,b", '\n\n"x"\n', "é\r\nü", "", '5" pipe', "tail\n", "a\rb", '"', '""', "\n"]


def put(path, data):
    with open(path, "wb") as out:
        out.write(data if isinstance(data, bytes) else data.encode())
    return path


def table(seed, many=400, end="\r\n"):
    draw, out = random.Random(seed), io.StringIO(newline="")
    rows = [["id", "te\nxt", "n"]] + [[str(i), draw.choice(VALUES), draw.choice(["1", "x\ny", ""])] for i in range(many)]
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue(), rows


def cells(record):
    return next(csv.reader(io.StringIO(record, newline="")))


@pytest.mark.parametrize("size", [1, 37, 500, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_ranges_give_the_same_records(spark, folder, size, end, monkeypatch):
    monkeypatch.setattr(records, "READ", 64)
    many = 30 if size == 1 else 400
    text, rows = table(size, many, end)
    path = put(f"{folder}/m.csv", text)
    states = records.range_states(spark, [path], ",", size)
    assert states.count() == -(-len(text.encode()) // size)
    found = [cells(r.record) for r in records.records(states, ",", "UTF-8").collect()]
    assert sorted(found, key=lambda r: int(r[0])) == rows[1:]


def test_states_of_random_bytes(spark, folder):
    """The composed states are those of one pass from the start."""
    draw = random.Random(9)
    data = "".join(draw.choices('a,"\n', weights=[3, 2, 2, 2], k=3000)).encode()
    path = put(f"{folder}/r.csv", data)
    inside, states = False, {}
    at = 0
    for line in data.splitlines(keepends=True):
        states[at] = inside
        inside = records.ends_inside(line, b",", inside)
        at += len(line)
    for r in records.range_states(spark, [path], ",", 50).collect():
        later = [s for s in states if s >= r.start]
        if later:
            assert r.inside == states[min(later)], r


def test_quotes_open_fields_only_at_their_start():
    assert records.ends_inside(b'5" pipe,"open', b",", False)
    assert not records.ends_inside(b'5",6"', b",", False)
    assert not records.ends_inside(b'"a ""b"" c",d', b",", False)
    assert records.ends_inside(b'"a ""', b",", False)
    assert not records.ends_inside(b'end"x,y', b",", True)
    assert records.ends_inside(b'end","again', b",", True)
    assert records.ends_inside(b'a;"b,c', b";", False) and not records.ends_inside(b'a;"b,c', b",", False)


def test_headers_over_lines_keep_all_columns(spark, folder):
    a = put(f"{folder}/a.csv", 'a,"b\nx"\n1,2\n')
    b = put(f"{folder}/b.csv", 'a,"b\ny",c\n3,4,5\n6,7,8,9\n')
    frames = {g.header: delimited.read_group(spark, g, ",", overflow=True) for g in delimited.file_groups(delimited.profile(spark, folder))}
    assert frames['a,"b\ny",c'].columns == ["a", "b\ny", "c", "_overflow", "source_file"]
    assert sorted(tuple(r)[:4] for r in frames['a,"b\ny",c'].collect()) == [("3", "4", "5", None), ("6", "7", "8", "9")]
    parsed = file_load.parse_delimited(spark, [a, b], ",", {})
    assert [r.path.rsplit("/", 1)[1] for r in parsed.bad.collect()] == ["b.csv"]
    assert [(r.a, r["b\nx"]) for r in parsed.rows.collect()] == [(1, 2)]


def test_a_stray_quote_hides_no_open_field(spark, folder):
    """Both lines of the record have an even number of quotes."""
    put(f"{folder}/a.csv", 'h,i\n5","begin\nend",5"\nx,y\n')
    (row,) = delimited.profile(spark, folder).collect()
    assert row.multi_line
    (group,) = delimited.file_groups(delimited.profile(spark, folder))
    found = [tuple(r)[:2] for r in delimited.read_group(spark, group, ",").collect()]
    assert ("x", "y") in found and len(found) == 2


def test_latin1_mark_blank_lines_and_compression(spark, folder):
    put(f"{folder}/l.csv", 'id,name\n\n1,"caf\xe9\nbar"\n\n\n2,x'.encode("latin-1"))
    put(f"{folder}/u.csv", b'\xef\xbb\xbf"id",name\n3,"two\nlines"\n  \n4,"\n\n"')
    put(f"{folder}/z.csv.gz", gzip.compress(b'id,name\n5,"a\nb"\n6,"c"\n'))
    put(f"{folder}/h.csv", b'id,"na\nme"')
    rows = delimited.read_delimited(spark, folder).collect()
    found = sorted((r.id, r.name) for r in rows)
    assert found == [("1", "café\nbar"), ("2", "x"), ("3", "two\nlines"), ("4", "\n\n"), ("5", "a\nb"), ("6", "c")]


def test_a_large_file_takes_more_than_one_task(spark, folder):
    text, rows = table(5, 4000)
    path = put(f"{folder}/m.csv", text)
    found = records.records(records.range_states(spark, [path], ",", 20_000), ",", "UTF-8")
    used = found.selectExpr("spark_partition_id() AS p").distinct().count()
    assert used > 1 and found.count() == 4000
