"""Saved files, open attributes, page statuses and the tour of a site."""
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from sitegraph.operators import attributes as AT
from sitegraph.sources import files


def _files(spark, rows):
    return spark.createDataFrame(rows, "key string, file_name string, content binary")


def test_files_are_written_under_their_names_and_read_back(spark, tmp_path):
    rows = [("u1", "a.png", b"one"), ("u2", "a.png", b"two"), ("u3", "A.png", b"three"), ("u4", "_hidden", b""), ("u5", ".dot", b"\x00\xff"),
            ("u6", None, b"no name"), ("u7", "none", None), ("u8", "x/y z%20ü.pdf", b"four"), ("u1", "a.png", b"again"), ("u9", files.MANIFEST, b"5")]
    out = str(tmp_path / "out")
    saved = files.save(_files(spark, rows).coalesce(1), out)
    back = {(r.key, r.content) for r in files.read_back(saved).collect()}
    assert back == {(k, bytes(c)) for k, n, c in rows if n and c is not None}
    names = [r.file_name for r in saved.collect()]
    assert len({n.lower() for n in names}) == len(names) == 8 and {"a.png", "_hidden", ".dot", "x_y z%20ü.pdf"} <= set(names)
    assert sorted(os.path.basename(p) for p in glob.glob(out + "/*/*") + glob.glob(out + "/*/.*")) == sorted([*names, files.MANIFEST])
    files.save(_files(spark, [("v", "a.png", b"later")]), out)  # another job adds to the folder
    assert files.saved(spark, out).count() == 9
    assert files.save(_files(spark, []), str(tmp_path / "none")).count() == 0


def test_an_aborted_job_leaves_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    df = _files(spark, [(str(i), f"{i}.txt", b"x") for i in range(50)]).repartition(4)
    fail = F.when(F.col("key") == "37", F.raise_error(F.lit("lost"))).otherwise(F.col("file_name"))
    with pytest.raises(Exception, match="lost"):
        files.save(df.withColumn("file_name", fail.cast("string")), out)
    assert [f for _, _, fs in os.walk(out) for f in fs] == []


def test_attempts_that_do_not_count_leave_nothing(tmp_path):
    """Two attempts of a task wrote; one is committed."""
    import pyarrow as pa
    w = files.FileWriter(str(tmp_path), "job", ["key", "file_name", "content"])
    batch = pa.record_batch({"key": ["k"], "file_name": ["a"], "content": [b"x"]})
    w.write(iter([batch]))
    second = w.write(iter([batch]))
    w.commit([second, None])
    assert sorted(os.path.relpath(p, tmp_path) for p in glob.glob(str(tmp_path) + "/*/*")) == ["job-00000/a", f"job-00000/{files.MANIFEST}"]


def test_page_json_files(spark, sf, tmp_path):
    from sitegraph.operators import content as C
    from sitegraph.sources import sinks as SK
    from sitegraph.sources import tables as T
    rec = SK.page_records(C.page_content(T.pages(spark, sf), "text"), F.lit("20260101000000000"))
    saved = SK.write_page_json(rec, str(tmp_path / "pages"))
    got = {r.key: json.load(open(r.path.removeprefix("file:"), encoding="utf-8")) for r in saved.collect()}
    want = {r.url: {k: r[k] for k in ("url", "title", "content") if r[k]} for r in rec.collect()}
    assert got == want
    SK.write_page_lines(rec, str(tmp_path / "lines"))
    lines = [json.loads(x) for f in glob.glob(str(tmp_path / "lines/part-*")) for x in open(f, encoding="utf-8")]
    assert sorted(map(str, lines)) == sorted(map(str, want.values()))


def test_run_timestamp():
    from datetime import datetime, timezone
    from sitegraph.sources.sinks import run_timestamp
    assert run_timestamp(datetime(2026, 1, 2, 3, 4, 5, 678999, timezone.utc)) == "20260102030405678" and len(run_timestamp()) == 17


def test_dead_images_use_up_no_place(spark):
    from sitegraph.operators import assets as A
    from sitegraph.plans import fullscan as FS
    pages = spark.createDataFrame([(1, "https://h.org/p", '<img src="/dead.png"><img src="/ok.png"><img src="/more.png"><a href="/d.pdf">d</a>'),
                                   (2, "https://h.org/q", "")], "page_id long, url string, html string")
    stored = spark.createDataFrame([("https://h.org/dead.png", 404, None, "x"), ("https://h.org/ok.png", 200, None, "y"),
                                    ("https://h.org/more.png", 200, None, "z"), ("https://h.org/d.pdf", 200, 'attachment; filename="r.pdf"', "w")],
                                   "url string, status int, disposition string, body string")
    assert [r.file_name for r in A.image_manifest(pages, 1, assets_df=stored).collect()] == ["ok.png"]
    rec = {r.page_id: r for r in FS.full_scan_records(pages, stored, with_images=True, with_documents=True, max_images=1).collect()}
    assert [x.fileName for x in rec[1].imageFiles] == ["ok.png"] and rec[1].imageFiles[0].relativePath == "images/"
    assert [x.fileName for x in rec[1].documentFiles] == ["r.pdf"] and rec[1].documentFiles[0].relativePath == "docs/"
    assert not rec[2].imageFiles and not rec[2].documentFiles
    only = FS.full_scan_records(pages, stored, with_documents=True).where("page_id = 1").first()
    assert only.documentFiles[0].relativePath == "docs/" and "imageFiles" not in only
    assert not FS.full_scan_records(pages, with_images=True).where("page_id = 1").first().imageFiles


def test_insights_of_pages_that_cannot_be_read(spark):
    from sitegraph.operators import insights as I
    rows = [(1, "http://h.org/", ""), (2, "not a url", '<a href="https://x.org/a">x'), (3, "http://h.org/b", None), (4, None, "<p>x")]
    got = {r.page_id: r for r in I.page_insights(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i: r.status for i, r in got.items()} == {1: "ok", 2: "bad_page", 3: "bad_page", 4: "bad_page"}
    assert got[1].p == 0 and got[1].internal == 0 and got[2].internal is None and got[2].internal_links is None and got[4].word_count is None


def test_fields_of_any_document(spark):
    docs = ['{"a":1,"b":[{"c":"x"},{"c":null,"d":[[2]]}]}', '{"a":"s","b":[]}', "[1,2.5]", "null", "true", '{"a.b":{}}']
    df = spark.createDataFrame([(d,) for d in docs] + [("{not json",), (None,)], "body string").select(AT.parsed(F.col("body")).alias("v"))
    got = {(r.path, r.type): (r.n_values, r.n_rows) for r in AT.fields(df, "v").collect()}
    assert got[("$.b[].c", "STRING")] == (1, 1) and got[("$.b[]", "OBJECT")] == (2, 1) and got[("$.b", "ARRAY")] == (2, 2)
    assert got[("$.b[].d[][]", "BIGINT")] == (1, 1) and got[("$.a.b", "OBJECT")] == (1, 1) and got[("$", "OBJECT")] == (3, 3)
    assert {t for p, t in got if p == "$.a"} == {"BIGINT", "STRING"} and got[("$[]", "BIGINT")] == (1, 1)
    with pytest.raises(ValueError):
        AT.fields(df, "v", depth=2)
    schema = AT.merged_schema(df.where("cast(v as string) like '%c%'"), "v").first().schema
    assert "c: STRING" in schema and "d: ARRAY<ARRAY<BIGINT>>" in schema


def test_open_attributes(spark):
    df = spark.range(3).select("id", AT.attributes(url=F.concat(F.lit("u"), "id"), count=F.col("id"), none=F.when(F.col("id") == 1, F.lit("x"))).alias("a"))
    got = [json.loads(r.j) for r in df.orderBy("id").select(F.to_json("a").alias("j")).collect()]
    assert got == [{"url": "u0", "count": 0}, {"url": "u1", "count": 1, "none": "x"}, {"url": "u2", "count": 2}]


def test_tour_of_a_deep_and_a_wide_site(spark):
    from sitegraph.plans import tour
    deep = [("r", f"d{i:03d}", i, f"d{i - 1:03d}" if i else None) for i in range(40)]
    wide = [("s", "s", 0, None), *[("s", f"c{i:05d}", 1, "s") for i in range(9000)], ("s", "z", 2, "c00007")]
    t = tour.euler_tour(spark.createDataFrame(deep + wide, "root_url string, url string, depth int, parent_url string"))
    got = {(r.root_url, r.url): r for r in t.collect()}
    assert all((got["r", f"d{i:03d}"].enter, got["r", f"d{i:03d}"].leave, got["r", f"d{i:03d}"].reach) == (i + 1, 40, 39 - i) for i in range(40))
    assert (got["s", "s"].size, got["s", "s"].reach) == (9002, 2) and (got["s", "c00007"].enter, got["s", "c00007"].leave) == (9, 10)
    of = spark.createDataFrame([("r", "d035"), ("s", "s"), ("s", "c00008")], "root_url string, url string")
    below = tour.descendants(t, of).groupBy("root_url", "ancestor").count().collect()
    assert {(r.root_url, r.ancestor): r["count"] for r in below} == {("r", "d035"): 4, ("s", "s"): 9001}
