from __future__ import annotations

import csv
import io
import random

import pytest

from pedalmill.sources import records


def _file(rng, rows):
    """A CSV text with quoted breaks, commas and doubled quotes, and its records."""
    pieces = ["a", "b c", "", ",", '"', "\n", "\r\n", '""', "x" * 30, "é"]
    out, lines = io.StringIO(), []
    for i in range(rows):
        cells = [str(i)] + ["".join(rng.choice(pieces) for _ in range(rng.choice([1, 1, 1, 2, 5]))) for _ in range(3)]
        buffer = io.StringIO()
        csv.writer(buffer, lineterminator="").writerow(cells)
        lines.append(buffer.getvalue())
        out.write(lines[-1] + ("\r\n" if i % 3 == 0 else "\n"))
    return out.getvalue(), lines


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, v) for k, v in (("spark.sql.files.maxPartitionBytes", str(size)), ("spark.sql.files.openCostInBytes", "0"))]
    for k, v in old.items():
        spark.conf.set(k, v)


def read(spark, paths):
    rows = records.read_records(spark, [f"file:{p}" for p in paths]).collect()
    return sorted((r["path"].rsplit("/", 1)[-1], r["record"]) for r in rows)


@pytest.mark.parametrize("size", [1 << 20, 170, 40])
def test_records_equal_a_serial_reader(spark, tmp_path, small_splits, size):
    rng, want, paths = random.Random(size), [], []
    for n, rows in (("a.csv", 40), ("b.csv", 40), ("c.csv", 1)):
        text, lines = _file(rng, rows)
        (tmp_path / n).write_bytes(text.encode())
        want += [(n, r) for r in lines]
        assert len(list(csv.reader(io.StringIO(text, newline="")))) == len(lines)
        paths.append(tmp_path / n)
    (tmp_path / "plain.csv").write_text("x,y\n1,\"q, r\"\n\n2,5\" pipe\n")
    want += [("plain.csv", r) for r in ("x,y", '1,"q, r"', '2,5" pipe')]
    small_splits(size)
    assert read(spark, [*paths, tmp_path / "plain.csv"]) == sorted(want)


@pytest.mark.parametrize("size", [1 << 20, 30])
def test_a_stray_quote_costs_no_other_row(spark, tmp_path, small_splits, size):
    (tmp_path / "s.csv").write_text('h,i\n1,"a\nb"\n2,"open\n' + "".join(f"{i},z\n" for i in range(3, 40)))
    small_splits(size)
    got = [r for _, r in read(spark, [tmp_path / "s.csv"])]
    assert got == sorted(["h,i", '1,"a\nb"', '2,"open'] + [f"{i},z" for i in range(3, 40)])


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i} ""{i}""' for i in range(60))
    (tmp_path / "l.csv").write_text(f'h,i\n1,"{long}"\n2,b\n')
    small_splits(50)
    assert [r for _, r in read(spark, [tmp_path / "l.csv"])] == sorted(["h,i", f'1,"{long}"', "2,b"])


def test_states_of_lines():
    for line, outside, inside in (('a,b', False, True), ('a,"b', True, True), ('x",c', False, False), ('""', False, True),
                                  ('"', True, False), ('a"b', False, True), ('"a""', True, True), ('"a"" ""b",c', False, False), ('",\r', True, False), ('', False, True)):
        assert (records.ends_inside(line, False), records.ends_inside(line, True)) == (outside, inside), line


def test_split_states(spark, tmp_path, small_splits):
    text = 'a,"b\nc",d\n' * 30
    (tmp_path / "q.csv").write_text(text)
    small_splits(25)
    numbered = records.numbered_lines(records._lines(spark, [f"file:{tmp_path}/q.csv"]))
    rows = {r["start"]: r["before"] for r in records.split_states(numbered).collect()}
    # a split holds the lines that begin in it, but for one that begins at its first byte
    expect = {s: (text[:text.find("\n", s) + 1] if s else "").count('"') % 2 == 1 for s in rows}
    assert rows == expect and any(expect.values())


@pytest.mark.parametrize("size", [1 << 20, 64, 20])
def test_records_and_stray_quotes_beside_each_other(spark, tmp_path, small_splits, size):
    """Records within a split, over two and over many splits; then a record without an end, whose lines look like more of them."""
    body = ["h,i"] + [f'{i},"{"x" * (i % 9)}\n,""{i}"""' for i in range(30)] + ['30,"' + "\n".join("yy" * k for k in range(12)) + '"', "31,plain"]
    loose = ['32,"open'] + [f'{i},z" ""' for i in range(33, 60)]
    (tmp_path / "m.csv").write_text("\n".join(body + loose) + "\n")
    (tmp_path / "n.csv").write_text("\n".join(body) + "\n")
    small_splits(size)
    want = [("m.csv", r) for r in body + loose] + [("n.csv", r) for r in body]
    assert read(spark, [tmp_path / "m.csv", tmp_path / "n.csv"]) == sorted(want)


def test_small_splits_share_tasks_and_lines_are_not_shuffled(spark, tmp_path, small_splits):
    (tmp_path / "t.csv").write_text("".join(f'{i},"a\nb"\n' for i in range(2000)))
    small_splits(16)
    lines = records._lines(spark, [f"file:{tmp_path}/t.csv"])
    assert lines.rdd.getNumPartitions() <= 3 * spark.sparkContext.defaultParallelism
    found = records.read_records(spark, [f"file:{tmp_path}/t.csv"])
    assert found.count() == 2000 and found.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism
