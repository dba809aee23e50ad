"""Mixed folders of uploads: compression, encodings, headers, delimiters, conflicts between name and content."""

from __future__ import annotations

import bz2
import gzip
import json
import lzma

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bureaulake.sources import decode, detect, files

ROWS = [(str(i), f"näme {i}", str(i * 3)) for i in range(40)]


def table(sep=",", header=True, end="\n", rows=ROWS, quote=False):
    lines = [sep.join(f'"{v}"' if quote else v for v in r) for r in rows]
    return end.join((['id' + sep + 'who' + sep + 'n'] if header else []) + lines) + end


@pytest.fixture
def folder(tmp_path):
    def put(name, data):
        (tmp_path / name).write_bytes(data if isinstance(data, bytes) else data.encode())

    put("a.csv", table())
    put("b.csv", '"id","who, full","n"\n' + "\n".join(f'{i},"x, {i}",{n}' for i, _, n in ROWS) + "\n1,2,3,4\n7\n")
    put("c.tsv.gz", gzip.compress(table("\t").encode()))
    put("d.csv", table(end="\r\n").encode("utf-16"))
    put("e.csv", b"".join(x.encode("utf-16-be") for x in table()))
    put("f.csv", gzip.compress(table().encode()))  # the name doesn't tell
    put("g.csv.xz", lzma.compress(table(quote=True).encode()))
    put("h.txt", table("|"))
    put("i.csv", "\n".join(f"{i},{n},{n}" for i, _, n in ROWS))  # numbers from the first line on
    put("j.jsonl", "\n".join(json.dumps({"id": int(i), "in": {"who": w, "n": [int(n)]}}) for i, w, n in ROWS) + "\n{broken\n")
    put("k.json", json.dumps([{"id": int(i), "who": w} for i, w, _ in ROWS], indent=1))
    put("l.json", json.dumps([{"id": 1, "who": "ü"}], ensure_ascii=False).encode("utf-16"))
    put("m.csv", "{id},who\n" + "\n".join(f"{i},{w}" for i, w, _ in ROWS))  # looks like JSON, gives nothing as such
    put("n.csv", "\n".join(json.dumps({"id": int(i), "who": w}) for i, w, _ in ROWS))  # is JSON, whatever its name
    put("o.txt", "just\n\nwords here\n")
    put("p.csv.bz2", bz2.compress(table(";").encode("latin-1")))
    put("q.csv", b"")  # the listing leaves empty files out
    pq.write_table(pa.table({"id": [1, 2], "in": [{"who": "a"}, {"who": None}]}), tmp_path / "r.parquet")
    put("s.xlsx", b"PK\x03\x04" + bytes(200))
    put("t [1].csv", table())
    return str(tmp_path)


def test_layouts(spark, folder):
    found = {r["path"].rsplit("/", 1)[1]: r for r in detect.layouts(files.list_files(spark, folder)).collect()}
    got = {k: (r["format"], r["compression"], r["encoding"], r["separator"], r["header"], r["array"], r["native"]) for k, r in found.items()}
    assert got == {
        "a.csv": ("csv", None, "utf-8", ",", True, None, True), "b.csv": ("csv", None, "utf-8", ",", True, None, True),
        "c.tsv.gz": ("tsv", "gzip", "utf-8", "\t", True, None, True), "d.csv": ("csv", None, "utf-16-le", ",", True, None, False),
        "e.csv": ("csv", None, "utf-16-be", ",", True, None, False), "f.csv": ("csv", "gzip", "utf-8", ",", True, None, False),
        "g.csv.xz": ("csv", "xz", "utf-8", ",", True, None, False), "h.txt": ("txt", None, "utf-8", "|", True, None, True),
        "i.csv": ("csv", None, "utf-8", ",", False, None, True), "j.jsonl": ("json", None, "utf-8", None, None, False, True),
        "k.json": ("json", None, "utf-8", None, None, True, True), "l.json": ("json", None, "utf-16-le", None, None, True, False),
        "m.csv": ("json", None, "utf-8", None, None, False, True), "n.csv": ("json", None, "utf-8", None, None, False, True),
        "o.txt": ("txt", None, "utf-8", None, None, None, True), "p.csv.bz2": ("csv", "bzip2", "iso-8859-1", ";", True, None, True),
        "r.parquet": ("parquet", None, "binary", None, None, None, True),
        "s.xlsx": ("excel", None, "binary", None, None, None, False), "t [1].csv": ("csv", None, "utf-8", ",", True, None, True)}
    assert found["b.csv"]["names"] == ["id", "who, full", "n"] and found["i.csv"]["names"] == ["col_0", "col_1", "col_2"]
    assert found["m.csv"]["fallback"] == "csv" and found["n.csv"]["conflict"]


def test_read_all(spark, folder):
    rows = detect.read_all(spark, folder).withColumn("name", F.element_at(F.split("_file", "/"), -1)).collect()
    by = {}
    for r in rows:
        by.setdefault(r["name"], []).append(r)
    assert {k: len(v) for k, v in by.items()} == {
        **dict.fromkeys(["a.csv", "c.tsv.gz", "d.csv", "e.csv", "f.csv", "g.csv.xz", "h.txt", "i.csv", "j.jsonl", "k.json", "m.csv", "n.csv", "p.csv.bz2", "t [1].csv"], 40),
        "b.csv": 41, "l.json": 1, "o.txt": 2, "r.parquet": 2}
    for name in ("a.csv", "c.tsv.gz", "d.csv", "e.csv", "f.csv", "g.csv.xz", "h.txt", "p.csv.bz2", "t [1].csv"):
        assert sorted((r["id"], r["who"], r["n"]) for r in by[name]) == sorted(ROWS), name
    assert sorted((r["col_0"], r["col_2"]) for r in by["i.csv"]) == sorted((i, n) for i, _, n in ROWS)
    assert sorted((r["id"], r["in.who"], r["in.n"]) for r in by["j.jsonl"]) == sorted((i, w, f"[{n}]") for i, w, n in ROWS)
    assert sorted((r["{id}"], r["who"]) for r in by["m.csv"]) == sorted((i, w) for i, w, _ in ROWS)
    assert {r["who, full"] for r in by["b.csv"]} == {f"x, {i}" for i in range(40)} | {None}
    assert [r["who"] for r in by["l.json"]] == ["ü"] and sorted(r["text"] for r in by["o.txt"]) == ["just", "words here"]
    assert [(r["id"], r["in.who"]) for r in sorted(by["r.parquet"], key=lambda r: r["id"])] == [("1", "a"), ("2", None)]


def test_one_read_per_layout(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"u{i}.csv").write_text(table())
    found = detect.groups(detect.layouts(files.list_files(spark, str(tmp_path))))
    assert [(g.format, len(g.paths)) for g in found] == [("csv", 30)]
    assert detect.read_all(spark, str(tmp_path)).count() == 1200


def test_names_and_cells(spark):
    row = spark.createDataFrame([('a, a ,"b ""c"", d",,a', ","), ("x|y", "|"), ("p\tq\t", "\t")], "line string, sep string")
    got = [r["c"] for r in row.select(detect.cells(F.col("line"), F.col("sep")).alias("c")).collect()]
    assert got == [["a", "a", 'b "c", d', "", "a"], ["x", "y"], ["p", "q", ""]]
    names = row.limit(1).select(detect.unique_names(detect.cells(F.col("line"), F.col("sep"))).alias("c")).first()["c"]
    assert names == ["a", "a.1", 'b "c", d', "Unnamed: 3", "a.2"]


def test_decoding():
    assert decode.encoding_of("abc\n".encode("utf-16")) == ("utf-16-le", "utf-16-le")
    assert decode.encoding_of("abc, déf\n".encode("utf-16-be"))[0] == "utf-16-be"
    assert decode.encoding_of("é".encode()[:1]) == ("utf-8", None) and decode.encoding_of("é".encode()[:1], True)[0] == "iso-8859-1"
    assert decode.encoding_of(b"\x00\x01" * 50) == (None, None) and decode.encoding_of(b"") == (None, None)
    pieces = [b"a\r", b"\nb\rc", b"\n\nd"]
    assert list(decode.lines(iter(pieces), "utf-8")) == ["a", "b", "c", "", "d"]
    text = "ä€\n".encode("utf-16")
    assert list(decode.lines((text[i : i + 1] for i in range(len(text))), "utf-16")) == ["ä€"]


def test_clashing_names_and_unreadable_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,ID,a,a,a.1,_file,_bad\n1,2,3,4,5,6,7\n2,2,3,4,5,6,7\n")
    (tmp_path / "b.json").write_text('{"_file": "x", "_format": 1}\n{"_file": "y", "_format": 2}\n')
    (tmp_path / "c.json").write_text("[1, 2, 3]")
    (tmp_path / "d.xlsx").write_bytes(b"PK\x03\x04" + bytes(100))
    rows, problems = detect.read_report(spark, str(tmp_path))
    by = {r["_file"].rsplit("/", 1)[1] + str(k): r for k, r in enumerate(sorted(rows.collect(), key=lambda r: (r["_file"], r["id"] or "", r["_file.1"] or "")))}
    first = by["a.csv0"]
    assert [first[c] for c in ("id", "ID.1", "a", "a.1", "a.1.4", "_file.1", "_bad.1")] == ["1", "2", "3", "4", "5", "6", "7"]
    assert (by["b.json2"]["_file.1"], by["b.json2"]["_format.1"], by["b.json2"]["_format"]) == ("x", "1", "json") and len(by) == 4
    assert sorted((r["path"].rsplit("/", 1)[1], r["format"]) for r in problems.collect()) == [("c.json", "json"), ("d.xlsx", "excel")]


def test_broken_compression(spark, tmp_path):
    whole = gzip.compress(table().encode())
    (tmp_path / "x.dat").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "y.csv").write_bytes(gzip.compress(b"id,who\n1,2\n") + gzip.compress(b"3,4\n"))  # two parts
    rows = detect.read_all(spark, str(tmp_path), "y*").collect()
    assert sorted((r["id"], r["who"]) for r in rows) == [("1", "2"), ("3", "4")]
    assert detect.layouts(files.list_files(spark, str(tmp_path), "x*")).first()["compression"] == "gzip"


def test_empty_folder(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert detect.read_all(spark, str(tmp_path / "empty")).count() == 0
