"""Archives and their index against plain Python, and against gzip."""

import gzip
import hashlib
import random
import zlib

import pytest

from newsmart.llm import warc
from newsmart.llm.arrow import Stage


def expected(rows, least=100):
    first = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if page is not None and len(raw) >= least:
            first[raw] = min(page, first.get(raw, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        to = first.get(raw)
        to = None if to == page else to
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def some_pages(seed, n):
    r = random.Random(seed)
    hosts = ["a.example.com", "www.B.example.com:8080", "example.org", "x.example.com:443"]
    bodies = ["<p>é%d</p>" % i * r.randint(0, 60) for i in range(n // 3)]
    rows = []
    for i in range(n):
        path = r.choice(["", "/", "/a b", "/c?d=%d" % r.randrange(40), "/é/%d#x" % i, "/hot", "/hot", "/hot"])
        rows.append((i, f"{r.choice(['http', 'https'])}://{r.choice(hosts)}{path}", r.choice(bodies)))
    big = "<b>long</b>" * 400_000
    rows += [
        (None, "http://example.org/hot", bodies[-1]), (None, None, None), (n + 1, None, "x" * 99), (n + 2, "", "x" * 100), (n + 3, "nothing", "x" * 100),
        (n + 4, "http://e.org/a\r\nWARC-Type: x", "y" * 300), (n + 5, "http://e.org/" + "k" * 5000, "y" * 300), (n + 6, "http://e.org/" + "k" * 5001, None),
        (n + 7, "http://e.org/big", big), (n + 8, "http://e.org/big", big), (n + 2, "", "x" * 100), (n + 3, "nothing", "x" * 100), (-5, "http://[::1]:80/a", "\r\n\r\n" * 50),
    ]
    return rows


def frame(spark, rows, parts=3):
    schema = "page_id long, digest int, url string, html string, key string"
    return spark.createDataFrame([(p, 1, u, h, "k") for p, u, h in rows], schema).repartition(parts)


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_pages_come_back(spark, monkeypatch, seed):
    monkeypatch.setattr(warc, "BLOCK_LINES", 5)
    monkeypatch.setattr(warc, "KEY_BYTES", 20)
    rows = some_pages(seed, 200)
    got = warc.archived_pages(frame(spark, rows))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert listed(got) == expected(rows)
    assert sum(r.record_type == "revisit" for r in got.collect()) > 50


def test_stored_payloads_are_the_pages(spark):
    rows = some_pages(3, 60)
    stage, index = warc.archive(frame(spark, rows))
    found = warc.read_records(index, warc.lookup(index, warc.url_keys(frame(spark, rows))), payloads=True).collect()
    texts = {}
    for page, _, html in rows:
        texts.setdefault(page, set()).add((html or "").encode())
    stored = {r.page_id for r in found if r.record_type == "response"}
    for r in found:
        if r.record_type == "response":
            assert bytes(r.payload) in texts[r.page_id]
        else:
            assert bytes(r.payload) == b""
            assert r.refers_to in stored
    urls = {warc.clean_url(u) for _, u, _ in rows}
    assert {r.url for r in found} == urls


def test_lookup_finds_only_the_asked_keys(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rows = some_pages(4, 90)
    _, index = warc.archive(frame(spark, rows))
    asked = [r for r in rows if r[1] in ("", None, "nothing") or (r[1] and "hot" in r[1])]
    keys = {warc.url_key(u) for _, u, _ in asked}
    both = [r for r in rows if warc.url_key(r[1]) in keys]
    extra = [(1, "http://nobody.example/", ""), (2, "zzz", "")]
    got = warc.read_records(index, warc.lookup(index, warc.url_keys(frame(spark, asked + extra))))
    assert sorted(r.page_id or -1 for r in got.collect()) == sorted(r[0] or -1 for r in both)


def test_archives_are_plain_compressed_warc(spark):
    rows = some_pages(5, 50)
    stage = Stage(spark, "warc")
    folder = warc.write_archives(stage, frame(spark, rows))
    seen = []
    for path, length in warc._listing(spark, folder):
        raw = open(path.removeprefix("file:"), "rb").read()
        assert len(raw) == length
        data = gzip.decompress(raw)
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        while data:
            fields, begin = warc.headers(data)
            stop = begin + int(fields["content-length"])
            assert data[stop : stop + 4] == b"\r\n\r\n"
            seen.append(fields["warc-type"])
            data = data[stop + 4 :]
    assert len([k for k in seen if k != "warcinfo"]) == len(rows)


def test_scan_names_the_place_of_each_member():
    r = random.Random(6)
    records = [r.randbytes(r.choice([1, 10, 5000, 300_000])) for _ in range(20)]
    packed = [warc.member(x) for x in records]
    raw = b"".join(p + warc.EMPTY for p in packed)
    for step in (1, 7, 1000, 1 << 20):
        if step == 1:
            raw_step, packed_step = raw[: sum(len(p) + 20 for p in packed[:2])], packed[:2]
        else:
            raw_step, packed_step = raw, packed
        at = [0]

        def read(_, at=at, step=step, raw=raw_step):
            at[0] += step
            return raw[at[0] - step : at[0]]

        found = [(o, n) for o, n, _ in warc.members(read, lambda x: False)]
        place, want = 0, []
        for p in packed_step:
            want.append((place, len(p)))
            place += len(p) + len(warc.EMPTY)
        assert found == want
    with pytest.raises(ValueError, match="ends"):
        list(warc.members(_once(packed[3][:-3]), lambda x: False))


def _once(raw):
    parts = [raw, b""]
    return lambda _: parts.pop(0) if parts else b""


def test_damaged_payload_is_noticed():
    raw = warc.page_record(1, "http://a/", b"<p>fine</p>", hashlib.sha256(b"<p>fine</p>").hexdigest(), None, None)
    assert warc.parse(warc.member(raw))[:2] == (1, 11)
    with pytest.raises(ValueError, match="digest"):
        warc.parse(warc.member(raw.replace(b"<p>fine", b"<p>fins")))


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://www.Example.com/A?b#c", "com,example,www)/A?b"), ("https://user:p@x.org:443", "org,x)/"), ("https://x.org:8443?q", "org,x:8443)/?q"),
        ("not a url", "not%20a%20url"), (None, ""), ("http://[::1]:80/a", "[::1])/a"), ("http://é.fr/\n", "fr,é)/%0A"),
    ],
)
def test_keys(url, key):
    assert warc.url_key(url) == key
    assert warc.url_key(warc.clean_url(url)) == key


def test_index_file_has_blocks_directory_and_footer(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    lines = [(b"k%03d" % (i // 3), 0, i * 10, 10) for i in range(50)]
    path = tmp_path / "part-0"
    path.write_bytes(b"".join(m + warc.EMPTY for m in warc.index_members(iter(lines))))
    files = warc.Files()
    entries = warc.read_directory(files, str(path), path.stat().st_size)
    assert [e[0] for e in entries] == [lines[i][0] for i in range(0, 50, 4)]
    back = b"".join(zlib.decompress(files.read(str(path), o, n), 31) for _, o, n in entries)
    assert back == b"".join(b"%s %d %d %d\n" % x for x in lines)


def test_empty_table(spark):
    assert warc.archived_pages(frame(spark, [(1, "a", "b")]).limit(0)).collect() == []


def test_one_page_of_nothing(spark):
    assert listed(warc.archived_pages(frame(spark, [(None, None, None)]))) == expected([(None, None, None)])
