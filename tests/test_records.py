"""CSV records cut by many tasks against the whole-file reader."""

import csv
import random

import pytest

from ticketloom.fixed import REQUIRED_KEYS, SCALE_KEYS
from ticketloom.sources import tables
from ticketloom.sources.records import records, scan_quoted
from tests.test_files import small_splits

TEXTS = ["", "x", "two\nlines", "a,b", 'say "hi"', '"', '""', '\n', "\n\n\n", "crlf\r\nin", "é ü 漢 😀", "  blanks  ", "tab\tx", "اختبار\nسطر", "long " * 60, 'q",\n"q']


def whole_file(spark, path):
    """The reader that takes a file as one task."""
    return spark.read.csv(path, schema=tables.CSV_SCHEMA, multiLine=True, **tables.CSV_OPTIONS)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def tickets(rng, n):
    for _ in range(n):
        yield [str(rng.randrange(6)) if k in SCALE_KEYS else rng.choice(TEXTS) for k in REQUIRED_KEYS]


def write(path, rows, end="\r\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end, quoting=quoting)
        writer.writerow(REQUIRED_KEYS)
        writer.writerows(rows)


@pytest.mark.parametrize("end,quoting", [("\n", csv.QUOTE_MINIMAL), ("\r\n", csv.QUOTE_ALL)])
def test_equal_to_the_whole_file_reader(spark, tmp_path, end, quoting):
    rng = random.Random(3)
    for n, size in enumerate((0, 1, 40, 120)):
        write(tmp_path / f"{n}.csv", list(tickets(rng, size)), end, quoting)
    path = str(tmp_path / "*.csv")
    expected = rows_of(whole_file(spark, path))
    with small_splits(spark, "1500"):
        lines = scan_quoted(spark, path)
        assert lines.select("source", "block").distinct().count() > 40
        got = rows_of(tables.read_csv(spark, path))
    assert len(got) == 161 and any("crlf\r\nin" in row for row in got)
    if end == "\r\n":
        # that reader takes carriage returns out of fields too if records end in them
        got = sorted((tuple(v.replace("\r\n", "\n") if isinstance(v, str) else v for v in row) for row in got), key=repr)
    assert got == expected


def test_a_record_over_many_splits(spark, tmp_path):
    rows = list(tickets(random.Random(5), 30))
    place = REQUIRED_KEYS.index("description_ar")
    rows[3][place] = "\n".join('line "%d",' % k for k in range(3000))
    rows[29][place] = "last\n" * 2000
    write(tmp_path / "a.csv", rows, "\n")
    with small_splits(spark, "2000"):
        found = records(spark, str(tmp_path / "a.csv")).collect()
        got = rows_of(tables.read_csv(spark, str(tmp_path / "a.csv")))
    assert got == rows_of(whole_file(spark, str(tmp_path / "a.csv")))
    assert [r.line for r in found if r.is_header] == [1]
    begins, line = [], 1
    for row in [REQUIRED_KEYS, *rows]:
        begins.append(line)
        line += 1 + sum(v.count("\n") for v in row)
    assert sorted(r.line for r in found) == begins


def test_records_without_line_ends_are_not_shuffled(spark, tmp_path):
    rows = [[v.replace("\n", " ").replace("\r", " ") for v in row] for row in tickets(random.Random(6), 50)]
    write(tmp_path / "a.csv", rows, "\n")
    assert rows_of(tables.read_csv(spark, str(tmp_path / "a.csv"))) == rows_of(whole_file(spark, str(tmp_path / "a.csv")))
    (tmp_path / "empty.csv").write_text("")
    assert tables.read_csv(spark, str(tmp_path / "empty.csv")).collect() == []
    (tmp_path / "blank.csv").write_text("\n\n" + ",".join(REQUIRED_KEYS) + "\n\n" + ",".join("1" for _ in REQUIRED_KEYS))
    assert len(tables.read_csv(spark, str(tmp_path / "blank.csv")).collect()) == 1
