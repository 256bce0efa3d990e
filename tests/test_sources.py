"""File scans on small folders."""

import json

import numpy as np
import pytest

from paracorpus.operators import pages
from paracorpus.sources import files


def test_text_scans(spark, tmp_path):
    raw, fixed = tmp_path / "raw", tmp_path / "fixed"
    raw.mkdir()
    (raw / "tap4_page_0002.txt").write_bytes("b\r\nc".encode())
    (raw / "tap4_page_0001.txt").write_text("a\n")
    (raw / "tap4.txt").write_text("whole")
    got = files.read_pages(spark, str(fixed), str(raw)).orderBy("page").collect()
    assert [(r.volume, r.page, r.text) for r in got] == [("tap4", 1, "a\n"), ("tap4", 2, "b\nc")]
    names = {r.name for r in files.read_texts(spark, str(raw), "tap*.txt").where("not contains(name, '_page_')").collect()}
    assert names == {"tap4"}
    with pytest.raises(FileNotFoundError):
        files.read_pages(spark, str(fixed))
    with pytest.raises(FileNotFoundError):
        files.read_texts(spark, str(tmp_path / "none"))


def test_layout_scan(spark, tmp_path):
    for folder, name in (("tập 5 x", "b_12_res.json"), ("other", "b_1_res.json"), ("tập 4", "noname.json")):
        (tmp_path / folder).mkdir()
        blocks = [{"block_label": "text", "block_content": " two ", "block_id": 7}, {"block_label": "text", "block_content": "one", "block_order": 3}, {"block_label": "image", "block_content": "no"}, {"block_label": "text"}]
        (tmp_path / folder / name).write_text(json.dumps({"parsing_res_list": blocks}))
    got = files.read_layout(spark, str(tmp_path)).select("volume", "page", pages.render_blocks("blocks").alias("text")).collect()
    assert [(r.volume, r.page, r.text) for r in got] == [("tap5", 12, "one\n\ntwo")]


def test_matrix_image_and_json_scans(spark, tmp_path):
    np.save(tmp_path / "e.npy", np.arange(6, dtype="f4").reshape(3, 2))
    got = files.read_npy(spark, str(tmp_path / "e.npy"), "src").orderBy("idx").collect()
    assert [(r.side, r.idx, list(r.embedding)) for r in got] == [("src", i, [2.0 * i, 2.0 * i + 1]) for i in range(3)]
    (tmp_path / "tap6_0003.png").write_bytes(b"png")
    assert [(r.volume, r.page, bytes(r.content)) for r in files.read_images(spark, str(tmp_path)).collect()] == [("tap6", 3, b"png")]
    (tmp_path / "p.jsonl").write_text('{"src":"a","score":0.5,"src_idx":[1]}\n\n')
    r = files.read_pairs(spark, str(tmp_path / "p.jsonl")).where("score is not null").first()
    assert (r.src, r.tgt, r.src_idx) == ("a", "", [1])


def test_folder_sinks(spark, tmp_path):
    p = spark.createDataFrame([("tap4", 1, "a"), ("tap4", 12, None)], "volume string, page int, text string")
    files.write_page_texts(p, str(tmp_path / "pages"))
    files.write_page_texts(p, str(tmp_path / "layout"), newline=False)
    assert (tmp_path / "pages/tap4_page_0001.txt").read_text() == "a\n" and (tmp_path / "layout/tap4_page_0012.txt").read_text() == ""
    assert files.read_pages(spark, str(tmp_path / "pages")).count() == 2
    files.write_images(p.select("volume", "page", p.volume.cast("binary").alias("content")), str(tmp_path / "images"))
    assert (tmp_path / "images/tap4_0012.png").read_bytes() == b"tap4"
    v = spark.createDataFrame([(i, [float(i), 0.5]) for i in range(5)], "idx long, embedding array<float>")
    files.write_npy(v, str(tmp_path / "npy"), rows=3)
    assert np.concatenate([np.load(x) for x in sorted((tmp_path / "npy").glob("*.npy"))]).tolist() == [[i, 0.5] for i in range(5)]
    files.write_aligner_files(v.selectExpr("idx", "concat('s', idx, chr(10), 'x') as text", "embedding"), str(tmp_path / "side"))
    assert [r.value for r in spark.read.text(str(tmp_path / "side/text")).collect()].count("s3 x") == 1
    raw = spark.read.parquet(str(tmp_path / "side/vectors")).orderBy("idx").collect()
    assert [np.frombuffer(r.raw, "<f4").tolist() for r in raw] == [[i, 0.5] for i in range(5)]
    files.write_report({"n": 2, "x": None}, str(tmp_path / "r"))
    assert json.loads((tmp_path / "r/report.json").read_text()) == {"n": 2, "x": None} and "| x | – |" in (tmp_path / "r/report.md").read_text()


def test_volume_and_parallel_scans(spark, tmp_path):
    (tmp_path / "tap5.txt").write_text("five")
    (tmp_path / "tap4.txt").write_text("four")
    (tmp_path / "tap4_page_0001.txt").write_text("page")
    assert [(r.volume, r.text) for r in files.read_volumes(spark, str(tmp_path)).collect()] == [("tap4", "four"), ("tap5", "five")]
    (tmp_path / "a").write_text("x\ny\n")
    (tmp_path / "b").write_text("1\n2\n")
    got = files.read_parallel(spark, str(tmp_path / "a"), str(tmp_path / "b")).orderBy("idx").collect()
    assert [tuple(r) for r in got] == [(0, "x", "1"), (1, "y", "2")]
    (tmp_path / "b").write_text("1\n")
    with pytest.raises(ValueError):
        files.read_parallel(spark, str(tmp_path / "a"), str(tmp_path / "b"))
