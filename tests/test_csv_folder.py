"""CSV folders read in blocks, against one reader of the whole file."""

import csv
import io
import random

import pytest

from fieldglean.sources import csv_folder


def plain(text):
    """Rows of a file as the csv module reads it whole."""
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    return [dict(zip(rows[0], [v or None for v in r])) for r in rows[1:]]


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_blocks_see_what_one_reader_sees(spark, tmp_path, block):
    rng = random.Random(block)
    want = []
    for name, columns in (("a b.csv", ["x", "y"]), ("c.csv", ["z", "x", "w"]), ("crlf.csv", ["y"])):
        out = io.StringIO(newline="")
        w = csv.writer(out, lineterminator="\r\n" if name == "crlf.csv" else "\n", quoting=csv.QUOTE_ALL if name == "c.csv" else csv.QUOTE_MINIMAL)
        w.writerow(columns)
        for _ in range(30):
            w.writerow(["".join(rng.choice('ab,"\n é') for _ in range(rng.randint(1, 12))) for _ in columns])
        (tmp_path / name).write_text(out.getvalue(), newline="")
        want += [(str(r.get("w")), str(r.get("x")), str(r.get("y")), str(r.get("z"))) for r in plain(out.getvalue())]
    rows, left_out = csv_folder.read(spark, str(tmp_path), block=block)
    assert rows.columns == ["w", "x", "y", "z", *csv_folder.MARKS]
    assert sorted((str(r.w), str(r.x), str(r.y), str(r.z)) for r in rows.collect()) == sorted(want)
    assert left_out.count() == 0


@pytest.mark.parametrize("block", [5, 1 << 20])
def test_what_is_left_out_has_its_line(spark, tmp_path, block):
    (tmp_path / "a.csv").write_text('X,y\n1,"two\nlines"\n5,6,7\n\n8\n' + "9," + "z" * 50 + "\n3,4")
    (tmp_path / "b.csv").write_bytes(b"\xef\xbb\xbfx,q\n\xff,1\n2,3\n")
    (tmp_path / "blank.csv").write_text("\n\n")
    (tmp_path / "twice.csv").write_text("k,K\n1,2\n")
    (tmp_path / "open.csv").write_text('x,y\n1,2\n3,"never closed\n4,5\n')
    (tmp_path / "latin.csv").write_bytes(b"\xe9,x\n1,2\n")
    rows, left_out = csv_folder.read(spark, str(tmp_path), block=block, most=40)
    name = lambda p: p.rsplit("/", 1)[-1]
    got = sorted((name(r["__path"]), r["__line"], r["X"], r["y"], r["q"]) for r in rows.collect())
    assert got == [("a.csv", 2, "1", "two\nlines", None), ("a.csv", 8, "3", "4", None), ("b.csv", 3, "2", None, "3"),
                   ("open.csv", 2, "1", "2", None), ("open.csv", 3, "3", "never closed\n4,5", None)]
    assert sorted((name(r.path), r.line or 0, r.reason) for r in left_out.collect()) == sorted([
        ("a.csv", 4, csv_folder.FIELDS), ("a.csv", 6, csv_folder.FIELDS), ("a.csv", 7, csv_folder.LONG), ("b.csv", 2, csv_folder.ENCODING),
        ("blank.csv", 0, csv_folder.NO_HEADER), ("twice.csv", 0, csv_folder.TWICE), ("latin.csv", 0, csv_folder.ENCODING)])


def test_a_folder_without_usable_files(spark, tmp_path):
    (tmp_path / "blank.csv").write_text("\n")
    rows, left_out = csv_folder.read(spark, str(tmp_path))
    assert rows.columns == list(csv_folder.MARKS) and rows.count() == 0 and left_out.count() == 1
