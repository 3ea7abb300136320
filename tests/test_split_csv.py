"""CSV files with line breaks in cells, read by splits: the same rows wherever the splits fall."""

import csv
import io
import os
import random
import tracemalloc

from pyspark.sql import functions as F

from flowlens.sources import split_csv
from flowlens.sources.csv_sources import read_cicflow_csv
from flowlens.sources.split_csv import line_ends, quoted_spans, records, split_states
from tests.test_sources import _local, _write


def _text(rnd, rows):
    cell = lambda: "".join(rnd.choice(['a', 'b', ' ', 'é', '"', '""', ',', '\n', '\r\n', '\n\n', '日']) for _ in range(rnd.randint(0, 9)))
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=rnd.choice(["\n", "\r\n"]))
    table = [[f"10.0.0.{i}", cell(), cell()] for i in range(rows)]
    writer.writerow([" Source IP", "Flow ID", " Label"])
    for row in table:
        writer.writerow(row)
        if rnd.random() < 0.1:
            out.write("  \n")
    return out.getvalue(), table


def test_records_do_not_depend_on_the_splits():
    rnd = random.Random(5)
    for _ in range(150):
        text, table = _text(rnd, rnd.randint(0, 12))
        data = text.encode()
        size = rnd.choice([1, 2, 3, 7, 16, 64, 1000])
        inside, got = False, []
        for start in range(0, len(data), size):
            part = data[start:start + size]
            got += records(io.BytesIO(data), start, len(part), inside)
            before = data[start - 1:start] if start else b"\n"
            inside = quoted_spans(part, before, inside)[2]
        rows = [next(csv.reader(io.StringIO(r.decode(), newline=""))) for r in got if r.strip()]
        assert rows[1:] == table


def test_quotes_inside_unquoted_cells_are_characters():
    data = b'a,5" disk,"x\ny",z\nb,"q""\n",c"d\n'
    spans = quoted_spans(data, b"\n", False)
    assert [data[a:b] for a, b in zip(*spans[:2])] == [b'"x\ny"', b'"q""\n"'] and spans[2] is False
    assert [int(x) for x in line_ends(data, *spans[:2])] == [17, len(data) - 1]


def test_states_along_a_file(spark, workdir):
    """Splits inside a long cell know it, though nothing in them says so."""
    path = _write(f"{workdir}/a.csv", 'h1,h2\n1,"' + "line\n" * 400 + '"\n2,5" x\n3,"u\nv"\n' * 3)
    with open(_local(path), "rb") as f:
        data = f.read()
    got = {r.start: r.inside for r in split_states(spark, [path], 97).collect()}
    inside, want = False, {}
    for start in range(0, len(data), 97):
        want[start] = inside
        inside = quoted_spans(data[start:start + 97], data[start - 1:start] if start else b"\n", inside)[2]
    assert got == want and any(want.values()) and not all(want.values())


def test_file_with_line_breaks_is_read_by_many_tasks(spark, workdir):
    rnd = random.Random(11)
    text, table = _text(rnd, 400)
    d = _local(f"{workdir}/many")
    path = _write(f"{d}/flows.csv", text)
    assert os.path.getsize(path) > 5_000
    whole = read_cicflow_csv(spark, [path])
    cut = read_cicflow_csv(spark, [path], split_bytes=700)
    key = lambda r: (r.src_ip, r.label)
    assert sorted(map(key, cut.collect())) == sorted(map(key, whole.collect()))
    assert {r.src_ip for r in cut.collect()} == {row[0] for row in table}
    want = {(row[0], row[2]) for row in table if row[2].strip().lower() not in ("nan", "inf")}
    assert {(r.src_ip, r.label) for r in cut.collect()} == want
    assert cut.select(F.spark_partition_id()).distinct().count() > 1


def test_blocks_give_the_records_of_whole_splits(monkeypatch):
    """Splits read in blocks of a few bytes, quotes at block ends and bytes that are not UTF-8 included."""
    rnd = random.Random(7)
    for _ in range(200):
        text, table = _text(rnd, rnd.randint(0, 12))
        data = text.encode() + rnd.choice([b"", b'5""6,x,y', b"\xff\xfe,a\n", b'"open\n', b"r\r"])
        whole = records(io.BytesIO(data), 0, len(data), False)
        monkeypatch.setattr(split_csv, "BLOCK_BYTES", rnd.choice([1, 2, 3, 5, 8, 40]))
        monkeypatch.setattr(split_csv, "PAST_BYTES", rnd.choice([1, 2, 7]))
        cut = rnd.randint(1, max(len(data) - 1, 1))
        while data[cut - 1:cut] == b'"':  # a split between two quotes is another matter
            cut -= 1
        inside = quoted_spans(data[:cut], b"\n", False)[2] if cut else False
        got, texts = [], []
        for start, size, state in [(0, cut, False), (cut, len(data) - cut, inside)]:
            if size > 0:
                got += records(io.BytesIO(data), start, size, state)
                assert split_csv.split_states_of(io.BytesIO(data), start, size)[state] == quoted_spans(
                    data[start:start + size], data[start - 1:start] if start else b"\n", state)[2]
                for found in split_csv.record_blocks(io.BytesIO(data), start, size, state):
                    texts += split_csv.record_texts(*found).to_pylist()
        monkeypatch.undo()
        assert got == whole
        assert texts == [r.decode("utf-8", errors="replace") for r in whole]


def test_memory_does_not_grow_with_the_split():
    """What a task holds is a block, not its split."""
    row = b'10.0.0.1,"a\nb",' + b"0," * 40 + b"x\n"

    def peak(n):
        data = io.BytesIO(row * n)
        tracemalloc.start()
        found = sum(len(split_csv.record_texts(*b)) for b in split_csv.record_blocks(data, 0, n * len(row), False))
        assert found == n and split_csv.split_states_of(data, 0, n * len(row)) == [False, False]
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert peak(320_000) < 1.2 * peak(40_000)
