import hashlib
from pathlib import Path

import pyarrow.fs
import zstandard

from tidemark.llm import warc
from tidemark.llm.queries import all_queries

SCHEMA = "page_id bigint, url string, html string, path string"


def _expected(rows):
    first, out = {}, []
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    for i, p in payloads:
        if len(p) >= 100 and i is not None:
            first[p] = min(i, first.get(p, i))
    for i, p in payloads:
        revisit = len(p) >= 100 and first.get(p, i) != i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", first[p] if revisit else None))
    return sorted(out, key=repr)


def _found(df):
    rows = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted(map(tuple, rows), key=repr)


ROWS = [
    (3, "http://a", "x" * 100),
    (1, None, "x" * 100),
    (2, "http://c", "x" * 100),
    (2, "http://c", "x" * 100),
    (4, "http://d\r\nWARC-Type: metadata", None),
    (5, "http://e", ""),
    (6, "http://f", "short"),
    (7, "http://g", "short"),
    (8, "http://h", "é\r\n\r\nWARC/1.1\r\n" * 40),
    (9, "http://h", "é\r\n\r\nWARC/1.1\r\n" * 40),
    (10, "http://i", "long " * 200_000),
    (None, "http://j", "y" * 200),
    (11, "http://j", "y" * 200),
]


def test_odd_rows_come_back(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "p") for r in ROWS], SCHEMA).repartition(3)
    index = warc.archive(pages, str(tmp_path / "bundles"))
    assert _found(warc.read_bundles(index)) == _expected(ROWS)
    empty = warc.archive(pages.limit(0), str(tmp_path / "none"))
    assert empty.count() == 0 and warc.read_bundles(empty).count() == 0


def test_bundles_are_seekable_and_plain_zstandard(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2_000)
    rows = [(i, f"http://{i}", f"page {i} " * (20 + i % 9)) for i in range(300)]
    pages = spark.createDataFrame([(*r, "p") for r in rows], SCHEMA).coalesce(1)
    index = warc.archive(pages, f"file://{tmp_path}/bundles")
    files = list(Path(tmp_path, "bundles").iterdir())
    assert len(files) == index.select("path").distinct().count()
    plain = b""
    for f in files:
        plain += zstandard.ZstdDecompressor().stream_reader(f.open("rb"), read_across_frames=True).read()
        with pyarrow.fs.LocalFileSystem().open_input_file(str(f)) as file:
            assert sum(e[2] for e in warc.seek_table(file)) > 0
    assert plain.count(b"WARC/1.1\r\n") == 300
    wanted = spark.createDataFrame([(7,), (299,), (1000,)], "page_id bigint")
    found = {r.page_id: bytes(r.record) for r in warc.fetch(index, wanted).collect()}
    assert found.keys() == {7, 299}
    fields, block, end = warc.parse(found[299], 0)
    assert fields["X-Page-ID"] == "299" and block.endswith(rows[299][2].encode()) and end == len(found[299])


def test_query_has_revisits(spark):
    sf = "/root/testdata/sf0.1"
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()
    assert _found(all_queries()["op9_warc_bundles"](spark, sf)) == _expected([tuple(p) for p in pages])
