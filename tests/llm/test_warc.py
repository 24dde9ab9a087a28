import hashlib

from tidelog.llm import warc
from tidelog.llm.warc import BundleReader, read_archive, write_archive
from tidelog.session import scratch_folder


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 4000)
    long, copy = "<p>" + "é" * 30000, "<html>" + "c" * 200
    rows = [(i, f"http://h/{i}", f"<b>{i}</b>" * 20) for i in range(30)]
    rows += [(40, "http://a\r\nX: y", copy), (39, None, copy), (38, "u", copy), (38, "u", copy), (50, "s", "tiny"), (51, "s", "tiny")]
    rows += [(60, "n", None), (61, "e", ""), (62, "l", long), (None, "x", "<i>" * 60)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, kind string")
    folder = scratch_folder(spark, "warc-test")
    index = write_archive(pages.repartition(3), folder)
    got = read_archive(index, folder).collect()
    assert len(got) == len(rows) == index.count()
    body = {(r[0] if r[0] is not None else ""): (r[2] or "").encode() for r in rows}
    for r in got:
        page = r["record_id"].split(":")[0]
        raw = body[int(page) if page else ""]
        assert r["payload_bytes"] == len(raw) and r["payload_digest"] == hashlib.sha256(raw).hexdigest()
    kinds = sorted((r["record_id"], r["record_type"], r["refers_to"]) for r in got if r["record_id"][:2] in ("38", "39", "40"))
    assert kinds == [
        ("38", "response", None), ("38:2", "revisit", "38"), ("39", "revisit", "38"), ("40", "revisit", "38"),
    ]
    assert all(r["record_type"] == "response" for r in got if r["record_id"] in ("50", "51", "60", "61"))
    # any record by its place in the index
    for r in index.collect():
        record = BundleReader(folder, r["bundle"]).record(r["frame"], r["offset"])
        assert record.identifier == r["record_id"]
        if record.headers["WARC-Type"] == "response":
            page = r["record_id"].split(":")[0]
            assert record.payload == body[int(page) if page else ""]


def test_empty_table(spark):
    folder = scratch_folder(spark, "warc-test")
    index = write_archive(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert read_archive(index, folder).count() == 0
