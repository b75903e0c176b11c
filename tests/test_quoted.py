"""Quoted CSV and file digests, read range by range."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.fingerprint import table_fingerprint
from tidemark.sources import quoted, readers


@pytest.fixture
def ranges(spark):
    """Files are cut into ranges of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def cut(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield cut
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


def value(rng):
    kind = rng.randrange(7)
    if kind == 0:
        return "".join(rng.choice('ab,"\n \r') for _ in range(rng.randrange(30)))
    if kind == 1:
        return '"\n' * rng.randrange(9)
    return [None, "", "plain", 'say "hi"', "é,日本\n\n,x"][rng.randrange(5)]


def field(v, rng):
    if v is None:
        return ""
    if any(c in v for c in ',"\n\r') or rng.random() < 0.3 or v == "":
        return '"' + v.replace('"', '""') + '"'
    return v


@pytest.mark.parametrize(("end", "size"), [("\n", 1000), ("\r\n", 1500), ("\n", 1 << 20)])
def test_equals_the_multi_line_reader(spark, tmp_path, ranges, rows, end, size):
    rng = random.Random(len(end) + size)
    for name in ("a.csv", "b.csv"):
        records = [["text", "label", "more"]]
        records += [[value(rng), str(i), value(rng)] for i in range(400)] + [[None, "7", "last"]]
        if end == "\r\n":
            records = [[v and v.replace("\r", "") for v in r] for r in records]
        text = end.join(",".join(field(v, rng) for v in r) + ("" if rng.random() < 0.9 else end) for r in records)
        (tmp_path / name).write_bytes((text + (end if name == "a.csv" else "")).encode())
    ranges(size)
    schema = "text string, label int, more string"
    want = spark.read.schema(schema).options(header=True, quote='"', escape='"', multiLine=True).csv(str(tmp_path))
    got = quoted.read_quoted_csv(spark, str(tmp_path), schema)
    assert rows(got) == rows(want)


def test_a_file_is_read_in_as_many_tasks_as_it_has_ranges(spark, tmp_path, ranges, rows):
    body = "".join(f'"line {i}\n, still ""{i}""",{i % 3}\n' for i in range(4000))
    (tmp_path / "x.csv").write_text("text,label\n" + body)
    ranges(len(body) // 63)
    assert quoted.lines(spark, f"{tmp_path}/x.csv").rdd.getNumPartitions() >= 64
    got = readers.read_coded_csv(spark, f"{tmp_path}/x.csv")
    assert got.count() == 4000
    assert got.where("label is null").count() == 0
    assert ('line 77\n, still "77"', "neutral") in rows(got)


def test_one_record_over_many_ranges(spark, tmp_path, ranges, rows):
    long = "\n".join(f'say ""{i}"", then' for i in range(500))
    (tmp_path / "x.csv").write_text(f'text\n"first"\n"{long}"\nlast')
    ranges(400)
    got = readers.read_headlines_csv(spark, f"{tmp_path}/x.csv")
    assert rows(got) == sorted([("first",), (long.replace('""', '"'),), ("last",)], key=repr)


def test_digests_do_not_depend_on_ranges_and_see_every_byte(spark, tmp_path, ranges):
    body = bytearray(random.Random(3).randbytes(5000) + b"\n\n\r\n" + b"x" * 300 + b"\n")
    folder = tmp_path / "d"
    (folder / "sub").mkdir(parents=True)
    (folder / "b").write_bytes(b"x")

    def digest(content, size=700):
        (folder / "sub/a.bin").write_bytes(content)
        ranges(size)
        found = {r["path"].rsplit("/", 1)[1]: r for r in quoted.file_digests(spark, str(folder)).collect()}
        assert found["b"]["length"] == found["b"]["n_lines"] == 1
        assert found["a.bin"]["length"] == len(content)
        return found["a.bin"]["digest"]

    first = digest(bytes(body))
    assert digest(bytes(body), 1 << 20) == first
    changed = {digest(bytes(body[:i]) + bytes([body[i] ^ 1]) + bytes(body[i + 1:])) for i in (0, 5001, len(body) - 1)}
    changed |= {digest(bytes(body[:-1])), digest(bytes(body) + b"\n")}
    assert len(changed) == 5 and first not in changed


def test_lines_are_numbered_without_sorting_them(spark, tmp_path, ranges):
    """The only window is that over the ranges; the numbers are those of the lines of the whole file."""
    rng = random.Random(5)
    contents = {n: rng.randbytes(6000) + b"\n" * 40 + b"y" * 1500 + rng.randbytes(900) for n in ("a", "b")}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    ranges(512)
    found = quoted.file_digests(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "rightHint=(strategy=broadcast)" in plan
    got = {r["path"][-1]: (r["n_lines"], r["digest"]) for r in found.collect()}
    for name, content in contents.items():
        parts = content.split(b"\n")
        numbered = [(i, hashlib.sha256(v).hexdigest()) for i, v in enumerate(parts[: len(parts) - (parts[-1] == b"")], 1)]
        whole = table_fingerprint(spark.createDataFrame(numbered, "number long, line string"), ["number", "line"])
        want = whole.select("n_rows", F.sha2(F.concat_ws(":", "digest", F.lit(len(content))), 256)).first()
        assert got[name] == tuple(want)
