"""CSV parsing, discovery and identity."""

import csv
import hashlib
import io
import json
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import write
from sluice.operators.contracts import BUILT_IN_CONTRACTS
from sluice.plans.ingest import verdicts_for_requests
from sluice.sources.csv import (
    RecordReader, block_effect, block_lines, block_records, parse_text_rows, read_governed_csv, start_states)
from sluice.sources.files import (
    directory_entries, discover_sources, discovery_failures, list_source_files, open_bytes, select_sources, source_identity)


def parse(spark, data: bytes):
    df = spark.createDataFrame([("f1", bytearray(data))], "source_id string, content binary")
    rows = read_governed_csv(df).collect()
    files = [r for r in rows if r["kind"] == "file"]
    recs = sorted([r for r in rows if r["kind"] == "row"], key=lambda r: r["row_number"])
    assert len(files) == 1
    return files[0], recs


def records(data: bytes):
    """(line, fields) of every record by the class, None if it is malformed."""
    reader = RecordReader()
    out = [(line + 1, fields) for t in data.decode().split("\n") for line, fields, _ in reader.feed(t)]
    return None if reader.broken or reader.inside else out


def standard(data: bytes):
    """The same by the standard library."""
    reader, out = csv.reader(io.StringIO(data.decode(), newline=""), strict=True), []
    try:
        while True:
            start = reader.line_num + 1
            fields = next(reader, None)
            if fields is None:
                return out
            if fields:
                out.append((start, fields))
    except csv.Error:
        return None


def test_reader_agrees_with_the_standard_library():
    rng = random.Random(8)
    seen = 0
    for _ in range(6000):
        text = "".join(rng.choice(['"', '"', ",", "\n", "\r\n", "\r", "x", "é ", '""', 'q"']) for _ in range(rng.randrange(14)))
        assert records(text.encode()) == standard(text.encode()), repr(text)
        seen += standard(text.encode()) is not None
    assert seen > 1000


@pytest.mark.parametrize("end", [b"\n", b"\r\n", b"\r"])
def test_line_ends(spark, end):
    f, rows = parse(spark, end.join([b"code,qty", b"K7,3", b'K8,"4"', b""]))
    assert f["failure_category"] is None and list(f["headers"]) == ["code", "qty"] and f["data_row_count"] == 2
    assert [(r["row_number"], list(r["vals"])) for r in rows] == [(2, ["K7", "3"]), (3, ["K8", "4"])]


def test_mark_blank_lines_and_quotes(spark):
    f, rows = parse(spark, '\ufeff\n\ncode,note\n\nK1,"two, ""x"" and\nthree"\n \n'.encode().replace(b"\n \n", b"\nK2,\n\n"))
    assert list(f["headers"]) == ["code", "note"]
    assert [(r["row_number"], list(r["vals"])) for r in rows] == [(5, ["K1", 'two, "x" and\nthree']), (7, ["K2", ""])]


@pytest.mark.parametrize("data,category,line", [
    (b"", "missing_header", None), (b"\n\r\n", "missing_header", None),
    (b"k,v\nA,\xff\n", "invalid_utf8", None), (b'k,v\n1,"open\n', "malformed_csv", None),
    (b'k,v\n1,"a"b\n', "malformed_csv", None), (b"k,v,k\n1,2,3\n", "duplicate_header", 1),
    (b"\nk,\n1,2\n", "empty_header", 2), (b"k,v\n1,2\n3\n4,\xff\n", "row_width", 3),
    (b"k,v\n1,\xff\n3\n", "invalid_utf8", None), (b'k,v\n1\n2,"x\n', "row_width", 2)])
def test_first_failure(spark, data, category, line):
    f, rows = parse(spark, data)
    assert (f["failure_category"], f["row_number"]) == (category, line) and rows == []
    if category == "row_width":
        assert (f["expected_field_count"], f["actual_field_count"]) == (2, 1)


def test_long_fields(spark):
    f, rows = parse(spark, b"k,v\n1," + b"z" * 400_000 + b"\n")
    assert f["failure_category"] is None and len(rows[0]["vals"][1]) == 400_000


def _document(rng, n, broken):
    rows = [["id", "note"]]
    for i in range(n):
        kind = rng.random()
        note = ("plain %d" % i if kind < .6 else "a\nb,%d\n" % i if kind < .8 else 'say "%d"' % i if kind < .95
                else "\n".join("long %d" % k for k in range(60)))
        rows.append([str(i), note])
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    data = out.getvalue().encode()
    if broken:
        data = data[:len(data) * 2 // 3] + b'"x\n' + data[len(data) * 2 // 3:]
    return data


def _compare(out, documents):
    for name, data in documents.items():
        mine = [r for r in out if r["source_identifier"].endswith("/" + name)]
        status = [r for r in mine if r["kind"] == "file"]
        rows = sorted((r["row_number"], list(r["vals"])) for r in mine if r["kind"] == "row")
        expect = standard(data)
        assert len(status) == 1
        if expect is None or any(len(f) != 2 for _, f in expect):
            assert status[0]["failure_category"] in ("malformed_csv", "row_width") and rows == []
        else:
            assert status[0]["failure_category"] is None and rows == expect[1:]


@pytest.mark.parametrize("block_bytes", [7, 300, 1 << 20])
def test_files_are_parsed_in_blocks(spark, tmp_root, block_bytes):
    rng = random.Random(3)
    sizes = [5, 60, 300] if block_bytes > 7 else [3, 8]
    documents = {f"f{i} +%41#.csv": _document(rng, rng.choice(sizes), i % 4 == 3) for i in range(8)}
    documents["unclosed.csv"] = b'id,note\n1,x\n2,"' + b"never closed\n" * 40
    documents["ends.csv"] = b'\xef\xbb\xbf"id","note"\r\n1,"a\r\nb"\r2,"c\r\rd"\r\n'
    for name, data in documents.items():
        write(tmp_root, "retail_sales/v1/" + name, data)
    files = list_source_files(spark, tmp_root)
    _compare(read_governed_csv(files, block_bytes).collect(), {
        n: d.removeprefix(b"\xef\xbb\xbf") for n, d in documents.items()})


def test_blocks_compose_to_the_whole_document(spark):
    """Effects of arbitrary blocks, composed, give the state that reading from the start gives."""
    rng = random.Random(5)
    effects, expect, documents = [], {}, {}
    for number in range(150):
        data = "".join(rng.choice(['"', '"', ",", "\n", "\n", "\r", "x", 'y"\n']) for _ in range(rng.randrange(1, 60))).encode()
        size, path = rng.randrange(1, 12), f"d{number}"
        documents[path] = data, size
        reader, at = RecordReader(), 0
        for start in range(0, len(data), size):
            file = io.BytesIO(data)
            effects.append((path, start, *block_effect(file, start, start + size), None))
            while at < start and not reader.broken:  # whole lines that begin before the block
                end = data.find(b"\n", at) + 1 or len(data)
                list(reader.feed(data[at:end].removesuffix(b"\n").decode()))
                at = end
            expect[path, start] = None if reader.broken else reader.inside
    got = start_states(spark.createDataFrame(
        effects, "path string, block long, outside boolean, inside boolean, ends boolean, n_lines long, failure string")).collect()
    assert len(got) == len(expect)
    states = {(r["path"], r["block"]): r for r in got}
    for key, state in expect.items():
        assert state is None or states[key]["starts_inside"] == state, key
    for path, (data, size) in documents.items():
        found = []
        for start in range(0, len(data), size):
            s = states[path, start]
            found += [(s["before"] + line + 1, f, bad) for line, f, bad in block_records(
                block_lines(io.BytesIO(data), start, start + size), s["starts_inside"], s["closes"])]
            if found and found[-1][2]:
                break
        whole = standard(data)
        if whole is None:
            assert found[-1][2] == "malformed_csv"
        else:
            assert [x[:2] for x in found] == whole and not any(x[2] for x in found), data


@pytest.mark.parametrize("megabytes", [1, 5, 20, 150])
def test_quoted_line_feeds_at_default_settings(spark, tmp_root, megabytes):
    path = f"{tmp_root}/retail_sales/v1/large.csv"
    os.makedirs(os.path.dirname(path))
    n = rows = total = 0
    with open(path, "w", newline="", encoding="utf-8") as file:
        file.write("id,note\n")
        while n < megabytes << 20:
            note = f"row {rows}" + ("\nover, \"several\"\nlines é" * (rows % 37) if rows % 3 else "")
            quoted = '"' + note.replace('"', '""') + '"' if rows % 3 else note
            n += file.write(f"{rows},{quoted}\n")
            total += zlib.crc32(f"{rows}|{note}".encode())
            rows += 1
    files = list_source_files(spark, tmp_root)
    assert files.first()["length"] == os.path.getsize(path)
    out = read_governed_csv(files)
    status = out.where("kind = 'file'").first()
    assert (status["failure_category"], status["data_row_count"]) == (None, rows)
    got = out.where("kind = 'row'").agg(F.count("*").alias("n"), F.sum(F.crc32(F.concat_ws("|", "vals"))).alias("s")).first()
    assert (got["n"], got["s"]) == (rows, total)


def test_a_file_that_went_away(spark, tmp_root):
    write(tmp_root, "retail_sales/v1/a.csv", b"x\n1\n")
    files = spark.createDataFrame(list_source_files(spark, tmp_root).collect())
    gone = files.withColumn("path", F.concat("path", F.lit(".csv"))).withColumn("source_id", F.lit("gone"))
    got = {r["source_id"]: r["failure_category"] for r in read_governed_csv(files.unionByName(gone)).where(
        "kind = 'file'").collect()}
    assert got["gone"] == "source_access" and sum(v is None for v in got.values()) == 1


def test_parse_text_rows(spark):
    df = spark.createDataFrame([("d1", "a,b\n1,2\n")], "source_id string, csv_text string")
    out = parse_text_rows(df).where("kind = 'row'").collect()
    assert [list(r["vals"]) for r in out] == [["1", "2"]]


def test_discovery_eligible_names_and_order(spark, tmp_root):
    _directories(tmp_root)
    d = "ecommerce_sales/v1/"
    for name in ["week 9.csv", "week-10.csv", "Ä.csv", "week.Csv", "week.csv.gz", ".week.csv",
                 "~week.csv", "#week.csv", "week.csv~", "2024/week.csv"]:
        write(tmp_root, d + name, b"x\n1\n")
    got = [r["source_identifier"] for r in discover_sources(spark, tmp_root).collect()]
    assert got == [d + "week 9.csv", d + "week-10.csv", d + "Ä.csv"]


def _directories(root):
    for c in BUILT_IN_CONTRACTS:
        os.makedirs(os.path.join(root, c.directory), exist_ok=True)


def test_empty_directories_are_an_empty_listing(spark, tmp_root):
    _directories(tmp_root)
    assert discover_sources(spark, tmp_root).count() == 0
    assert discovery_failures(spark, tmp_root).count() == 0


def test_directories_that_cannot_be_listed(spark, tmp_root):
    write(tmp_root, "ecommerce_sales/v1", b"a file")
    os.makedirs(os.path.join(tmp_root, "real"))
    os.makedirs(os.path.join(tmp_root, "retail_sales"))
    os.symlink(os.path.join(tmp_root, "real"), os.path.join(tmp_root, "retail_sales/v1"))
    got = {r["source_identifier"]: r["failure_category"] for r in discovery_failures(spark, tmp_root).collect()}
    assert got == {"product_catalog/v1": "missing_directory", "ecommerce_sales/v1": "not_a_directory",
                   "retail_sales/v1": "symbolic_link"}
    with pytest.raises(FileNotFoundError):
        discover_sources(spark, tmp_root)
    gone = discovery_failures(spark, tmp_root + "/nothing").collect()
    assert {r["failure_category"] for r in gone} == {"missing_root"} and len(gone) == 3
    assert list_source_files(spark, tmp_root + "/nothing").count() == 0


def test_links_are_refused(spark, tmp_root):
    """A link among the eligible files, above a directory, or out of the root fails its contract only."""
    root = os.path.join(tmp_root, "root")
    write(root, "product_catalog/v1/_a.csv", b"x\n1\n")
    write(root, "product_catalog/v1/b.csv", b"x\n1\n")
    os.symlink("b.csv", os.path.join(root, "product_catalog/v1/not eligible.txt"))
    os.makedirs(os.path.join(root, "product_catalog/v1/folder.csv"))
    write(root, "ecommerce_sales/v1/a.csv", b"x\n1\n")
    os.symlink("a.csv", os.path.join(root, "ecommerce_sales/v1/z.csv"))
    write(tmp_root, "elsewhere/v1/a.csv", b"x\n1\n")
    os.symlink(os.path.join(tmp_root, "elsewhere"), os.path.join(root, "retail_sales"))
    failed = {r["source_identifier"]: r["failure_category"] for r in discovery_failures(spark, root).collect()}
    assert failed == {"ecommerce_sales/v1": "symbolic_link", "retail_sales/v1": "symbolic_link"}
    listing = list_source_files(spark, root)
    assert sorted(r["source_identifier"] for r in listing.collect()) == ["product_catalog/v1/_a.csv", "product_catalog/v1/b.csv"]
    entries = directory_entries(spark, root)
    found = {r["name"]: (r["type"], r["is_link"], r["resolved"]) for r in entries.where("name is not null").collect()}
    assert found["folder.csv"][:2] == ("directory", False) and found["z.csv"][:2] == ("file", True)
    assert found["z.csv"][2] == os.path.realpath(os.path.join(root, "ecommerce_sales/v1/a.csv"))
    asked = spark.createDataFrame([("product_catalog/v1/b.csv",), ("ecommerce_sales/v1/z.csv",), ("product_catalog/v1/not eligible.txt",)],
                                  "requested_path string")
    got = {r["requested_path"]: r["selection"] for r in select_sources(asked, listing, entries=entries).collect()}
    assert got == {"product_catalog/v1/b.csv": "SELECTED", "ecommerce_sales/v1/z.csv": "source_selection",
                   "product_catalog/v1/not eligible.txt": "source_selection"}
    os.symlink(root, os.path.join(tmp_root, "link"))
    assert {r["failure_category"] for r in discovery_failures(spark, os.path.join(tmp_root, "link")).collect()} == {"symbolic_link"}


def test_hash_reads_the_file_piece_by_piece(spark, tmp_root):
    data = os.urandom(1 << 20) * 3 + b"end"
    path = write(tmp_root, "retail_sales/v1/a.csv", data)
    assert list_source_files(spark, tmp_root).first()["content_sha256"] == hashlib.sha256(data).hexdigest()
    with open_bytes("file://" + path) as file:
        file.seek(len(data) - 3)
        assert file.read() == b"end"


@pytest.mark.parametrize("spelling", ["{}", "{}/", "file:{}", "file://{}", "file://{}/"])
def test_every_spelling_of_the_root_lists_the_same(spark, tmp_root, spelling):
    _directories(tmp_root)
    write(tmp_root, "retail_sales/v1/a b.csv", b"x\n1\n")
    root = spelling.format(tmp_root)
    rows = list_source_files(spark, root).collect()
    assert [r["source_identifier"] for r in rows] == ["retail_sales/v1/a b.csv"]
    assert rows[0]["source_id"] == list_source_files(spark, tmp_root).first()["source_id"]


def test_select_sources(spark, tmp_root):
    write(tmp_root, "retail_sales/v1/a.csv", b"x\n1\n")
    listing = list_source_files(spark, tmp_root)
    req = spark.createDataFrame([("retail_sales/v1/a.csv", 1), ("retail_sales/v1/b.csv", 1),
                                 ("retail_sales/v1/a.csv", 1), (None, 1)], "requested_path string, n int")
    got = sorted((str(r["requested_path"]), r["match_count"], r["selection"])
                 for r in select_sources(req, listing).collect())
    assert got == [("None", 0, "source_selection"), ("retail_sales/v1/a.csv", 1, "SELECTED"),
                   ("retail_sales/v1/a.csv", 1, "SELECTED"), ("retail_sales/v1/b.csv", 0, "source_selection")]


def test_verdicts_of_requests(spark, tmp_root):
    header = b"sku,product_name,category_code,list_price,unit_cost,currency_code\n"
    write(tmp_root, "product_catalog/v1/ok.csv", header + b"A-1,Cup,HOME,2.50,,EUR\n")
    asked = spark.createDataFrame(
        [("northstar.product_catalog", 1), ("northstar.retail_sales", 1), ("northstar.retail_sales", 9),
         ("other.contract", 1), ("northstar.product_catalog", 1)], "contract_id string, contract_version int")
    got = {(r["contract_id"], r["contract_version"]): r for r in verdicts_for_requests(spark, tmp_root, asked).collect()}
    state = lambda key: (got[key]["state"], got[key]["failure_category"],
                         [x["state"] for x in got[key]["stages"]])
    assert len(got) == 4
    assert state(("northstar.product_catalog", 1)) == ("SUCCEEDED", None, ["SUCCEEDED"] * 3)
    assert state(("northstar.retail_sales", 1)) == ("FAILED", "INGESTION_FAILURE", ["FAILED", "SKIPPED", "SKIPPED"])
    for key in (("northstar.retail_sales", 9), ("other.contract", 1)):
        assert state(key) == ("FAILED", "CONFIGURATION_FAILURE", ["SKIPPED"] * 3)


def test_content_hash_and_identity(spark, tmp_root):
    data = b"\xef\xbb\xbfsku\r\nA\r\n"
    write(tmp_root, "product_catalog/v1/p.csv", data)
    row = list_source_files(spark, tmp_root).first()
    assert row["content_sha256"] == hashlib.sha256(data).hexdigest()
    payload = {"contract_id": "northstar.product_catalog", "contract_version": 1,
               "source_path": "product_catalog/v1/p.csv", "content_sha256": row["content_sha256"]}
    expect = hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":"),
                                       ensure_ascii=False).encode()).hexdigest()
    assert row["source_id"] == expect


def test_identity_payload_literal(spark):
    df = spark.createDataFrame([("northstar.retail_sales", 1, "retail_sales/v1/é.csv", "a" * 64)],
                               "cid string, v int, p string, h string")
    got = df.select(source_identity("cid", "v", "p", "h").alias("s")).first()["s"]
    payload = {"contract_id": "northstar.retail_sales", "contract_version": 1,
               "source_path": "retail_sales/v1/é.csv", "content_sha256": "a" * 64}
    assert got == hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":"),
                                            ensure_ascii=False).encode()).hexdigest()


def test_documents_held_as_bytes_need_no_join_and_no_stored_records(spark):
    rows = [(f"d{i}", i, f"a,b\n{i},x\n{i},y\n" + ("1\n" if i % 7 == 0 else "")) for i in range(200)]
    rows += [("none", 200, None), (None, 201, "a,b\n1,2\n"), ("long", 202, "a,b\n" + "1,2\n" * 20_000),
             ("late", 203, "a,b\n" + "1,2\n" * 20_000 + "1\n")]
    out = parse_text_rows(spark.createDataFrame(rows, "source_id string, n int, csv_text string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Join|Aggregate|ExistingRDD.*checkpoint", plan) and plan.count("MapInArrow") == 1
    got = {}
    for r in out.collect():
        got.setdefault((r["source_id"], r["n"]), []).append(r)
    files = {k: [r for r in v if r["kind"] == "file"] for k, v in got.items()}
    assert len(files) == len(rows) and all(len(v) == 1 for v in files.values())
    assert len(got["long", 202]) == 20_001 and files["long", 202][0]["data_row_count"] == 20_000
    assert [r["row_number"] for r in got["long", 202] if r["kind"] == "row"] == list(range(2, 20_002))
    late = files["late", 203][0]
    assert (len(got["late", 203]), late["failure_category"], late["row_number"]) == (1, "row_width", 20_002)
    assert [files[k][0]["failure_category"] for k in (("none", 200), (None, 201))] == ["missing_header"] * 2
    assert all(len(got[f"d{i}", i]) == (1 if i % 7 == 0 else 3) for i in range(200))
