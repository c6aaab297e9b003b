import base64
import gzip
import hashlib

import pytest

from lampyris.llm import warc

LONG = "x\r\n\r\nWARC/1.1\r\n" * 100
PAGES = [
    (1, "http://a/1", LONG), (2, "http://a/2", LONG), (9, "http://a/9", LONG), (3, "http://a/3", "short"), (4, "http://a/4", "short"), (5, None, None),
    (6, "http://a b/\r\nX: y", ""), (7, "https://é/ü?q", "é🎉" * 600), (8, "http://a/8", "z" * 3_000_000), (10, "http://h", "é🎉" * 600 + "\r\n\r\n"), (2, "http://a/2", LONG),
]


def test_round_trip(spark):
    pages = spark.createDataFrame([(h, p, u, 0) for p, u, h in PAGES], "html string, page_id long, url string, digest int").repartition(3)
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert len(got) == 10
    for p, u, h in PAGES:
        raw = (h or "").encode()
        r = got[p]
        assert (r.response.payload_bytes, r.response.digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        if p in (1, 2):
            assert r.response.kind == "revisit" and r.refers_to_page == 9 and r.response.payload is None
        else:
            assert r.response.kind == "response" and r.refers_to_page is None and bytes(r.response.payload) == raw
        assert len(r.requests) == len(r.metadata) == 1
        assert r.requests[0].startswith("GET ") and f"page-id: {p}\r\n" in r.metadata[0]
        assert r.target == (u and u.replace("\r\n", "%20%20").replace(" ", "%20"))


def test_null_ids_and_empty_table(spark):
    pages = spark.createDataFrame([(None, "u", LONG), (None, "u", LONG), (4, "u", LONG)], "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.response.kind, r.refers_to_page) for r in warc.round_trip(pages).collect())
    assert got == [(0, "revisit", 4), (4, "response", None)]
    assert warc.round_trip(pages.where("false")).count() == 0


def test_records_of_a_broken_archive():
    block = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    whole = gzip.compress(block) + gzip.compress(block)
    assert [b for _, b in warc.records(whole)] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.records(gzip.compress(block[:-6])))
    with pytest.raises(ValueError):
        list(warc.records(gzip.compress(b"junk\r\n\r\n")))


def _write(folder, *files):
    folder.mkdir()
    for i, file in enumerate(files):
        (folder / f"{i}.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in file))
    return str(folder)


def _made(kind, name, block, *headers):
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", "WARC-Date: 2020-01-01T00:00:00Z", *headers, f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _to(*names):
    return [f"WARC-Concurrent-To: <{n}>" for n in names]


def test_captures_are_linked_from_either_end(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\nhello"
    star = [_made("response", "r1", http, *_to("q1", "m1")), _made("request", "q1", b"GET 1"), _made("metadata", "m1", b"page-id: 1")]
    chain = [_made("metadata", "m2", b"a: b", *_to("q2")), _made("request", "q2", b"GET 2", *_to("r2")), _made("response", "r2", http)]
    many = [_made("response", "r3", http)] + [_made("metadata", f"m3{i}", b"n: %d" % i, *_to("r3")) for i in range(3)] + [_made("request", f"q3{i}", b"GET 3", *_to("r3", "m30")) for i in range(2)]
    alone = [_made("response", "r4", http), _made("request", "q5", b"GET 5", *_to("nowhere")), _made("warcinfo", "i", b"x: y")]
    folder = _write(tmp_path / "a", star[:2], star[2:] + chain, many + alone)
    got = {r.capture_id: r for r in warc.captures(warc.read_archives(spark, folder)).collect()}
    assert (got["r1"].requests, got["r1"].metadata, got["r1"].page_id) == (["GET 1"], ["page-id: 1"], 1)
    assert (got["r2"].requests, got["r2"].metadata) == (["GET 2"], ["a: b"])
    assert (got["r3"].requests, got["r3"].metadata) == (["GET 3"] * 2, ["n: 0", "n: 1", "n: 2"])
    assert got["r4"].requests == got["r4"].metadata == [] and bytes(got["r4"].response.payload) == b"hello"
    assert len(got) == 6 and sum(r.response is None for r in got.values()) == 2


def test_digest_forms_and_bad_records(spark, tmp_path):
    http, sha = b"HTTP/1.1 200 OK\r\n\r\nhello", hashlib.sha1(b"hello")
    base32 = base64.b32encode(sha.digest()).decode()
    good = [
        _made("response", "hex", http, f"WARC-Payload-Digest: sha1:{sha.hexdigest().upper()}"),
        _made("response", "base", http, f"WARC-Payload-Digest: sha1:{base32}"),
        _made("response", "other", http, "WARC-Payload-Digest: sha256:abc"),
        _made("response", "none", http),
        _made("response", "wrong", http, f"WARC-Payload-Digest: sha1:{'0' * 40}"),
        _made("revisit", "again", b"HTTP/1.1 304\r\nContent-Length: ?\r\n\r\n", "WARC-Payload-Digest: sha1:?"),
    ]
    folder = _write(tmp_path / "a", good, [good[0][:-9], good[1]], [b"junk\r\n\r\n"], [])
    (tmp_path / "a" / "9.warc.gz").write_bytes(b"no archive")
    found = warc.read_archives(spark, folder).collect()
    rows = {r.record_id: (r.digest, r.problem) for r in found if r.kind}
    assert rows["hex"] == rows["base"] == rows["none"] == (sha.hexdigest(), None)
    assert rows["other"] == ("sha256:abc", None) and rows["wrong"] == ("0" * 40, "payload and digest differ") and rows["again"][1] is None
    assert sum(r.kind is None and r.problem is not None for r in found) == 3


def test_large_pages_get_files_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4000)
    monkeypatch.setattr(warc, "SIZES", [100, 1000, 4000])
    pages = [(i, "http://a/", "x" * size) for i, size in enumerate([0, 50, 99, 500, 900, 3000, 3500, 9000])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"), least_bytes=10**6)
    files = [p for p in (tmp_path / "w").rglob("*.gz")]
    sizes = [sum(len(b) for h, b in warc.records(p.read_bytes()) if h["warc-type"] == ["response"]) for p in files]
    assert len(files) >= 5 and sorted(sizes)[-2] <= 4200
    assert warc.captures(warc.read_archives(spark, str(tmp_path / "w"))).count() == len(pages)
