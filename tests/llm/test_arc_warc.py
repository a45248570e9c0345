"""Archives of both versions, whole and damaged."""

import base64
import hashlib

import pytest

from tallyspan.llm import arc_warc, skewed

DATE = "20010203040506"


def archive(version, *bodies, kind="text/html"):
    out = arc_warc.arc_version_block(version, "n.arc", DATE)
    for k, body in enumerate(bodies):
        record = arc_warc.arc_record(version, f"http://a/{k}", DATE, body, "n.arc", len(out))
        out += record.replace(b" text/html ", f" {kind} ".encode(), 1)
    return out


def parsed(content, damage=None):
    return [(h["URL"], h["Content-type"], b) for h, b in arc_warc.parse_arc(content, damage)]


@pytest.mark.parametrize("version", [1, 2])
def test_spaces_in_a_content_type_belong_to_it(version):
    content = archive(version, b"one\n", b"two", kind="text/html; charset=x; v=1")
    assert parsed(content) == [(f"http://a/{k}", "text/html; charset=x; v=1", b) for k, b in enumerate((b"one\n", b"two"))]


def test_short_dates_of_older_archives():
    content = archive(1, b"x").replace(DATE.encode(), b"19970915")
    ((header, _),) = arc_warc.parse_arc(content)
    assert arc_warc.iso_date(header["Archive-date"]) == "1997-09-15T00:00:00Z"
    assert arc_warc.iso_date("199709151234") == "1997-09-15T12:34:00Z"


@pytest.mark.parametrize("version", [1, 2])
def test_damaged_records_are_left_out(version):
    whole = archive(version, b"first", b"second\nwith a line", b"third")
    cases = {
        "too few fields": whole.replace(b"http://a/1 0.0.0.0 " + DATE.encode(), b"http://a/1"),
        "no date or no length": whole.replace(b"http://a/1 0.0.0.0 " + DATE.encode(), b"http://a/1 0.0.0.0 soon"),
    }
    if version == 2:
        cases["checksum differs"] = whole.replace(b"second\n", b"Second\n")
    for reason, content in cases.items():
        with pytest.raises(ValueError, match=reason):
            parsed(content)
        damage = []
        assert [b for _, _, b in parsed(content, damage)] == [b"first", b"third"]
        assert [d[1] for d in damage] == [reason] and b"a/1" in damage[0][2].encode()
    damage = []
    assert [b for _, _, b in parsed(whole[:-4], damage)] == [b"first", b"second\nwith a line"]
    assert [d[1] for d in damage] == ["record ends early"]


def test_damage_in_a_table_of_archives(spark):
    good, bad = archive(1, b"HTTP/1.1 200 OK\r\nX-Page-Id: 7\r\n\r\nbody"), archive(2, b"one", b"two")[:-2]
    arcs = spark.createDataFrame([(good,), (bad,)], "content binary")
    with pytest.raises(Exception, match="ends early"):
        arc_warc.read_arc(arcs).collect()
    rows = arc_warc.read_arc(arcs, on_damage="skip").collect()
    assert sorted((r["kind"], r["page_id"] or 0, bytes(r["payload"])[:4]) for r in rows) == sorted(
        [("warcinfo", 0, b"1 0 "), ("warcinfo", 0, b"2 0 "), ("http", 7, b"body"), ("resource", 0, b"one")]
    )
    (lost,) = arc_warc.damaged_records(arcs).collect()
    assert (lost["file"], lost["reason"]) == ("filedesc://n.arc", "record ends early")
    with pytest.raises(ValueError, match="on_damage"):
        arc_warc.read_arc(arcs, on_damage="ignore")


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_what_a_warc_file_holds(spark, tmp_path, compression):
    pages = spark.createDataFrame([(1, "http://x/", "<p>a</p>"), (2, "http://y/", "<p>a</p>")], "page_id long, url string, html string").coalesce(1)
    arcs = arc_warc.pages_to_arc(pages)
    arc_warc.write_warc(arc_warc.staged(arc_warc.read_arc(arcs), "test"), str(tmp_path / "w"), compression)
    files = [f.read_bytes() for f in sorted((tmp_path / "w").glob("part-*"))]
    records = [r for content in files for r in arc_warc.parse_warc(content)]
    assert all((f[:2] == b"\x1f\x8b") == (compression == "gzip") for f in files)
    info, one, two = (h for h, _ in records)
    assert [h["WARC-Type"] for h in (info, one, two)] == ["warcinfo", "revisit", "response"]
    assert info["WARC-Filename"].endswith(".arc") and records[0][1].startswith(b"1 0 tallyspan\n")
    assert one["WARC-Warcinfo-ID"] == two["WARC-Warcinfo-ID"] == info["WARC-Record-ID"]
    assert one["WARC-Refers-To"] == two["WARC-Record-ID"] and two["WARC-IP-Address"] == "0.0.0.0"
    assert two["WARC-Date"] == "2024-01-01T00:00:00Z"
    assert records[2][1].endswith(b"\r\n\r\n<p>a</p>") and records[1][1].endswith(b"\r\n\r\n")


@pytest.mark.parametrize("share", [1, 4, 1024])
def test_many_pages_of_one_payload(spark, monkeypatch, share):
    monkeypatch.setattr(skewed, "SHARE", share)
    given = [(i, f"http://a/{i}", "" if i % 3 == 0 else f"page {i % 40}") for i in range(600)]
    pages = spark.createDataFrame(given, "page_id long, url string, html string").repartition(5)
    top = {}
    for i, _, h in given:
        top[h] = max(top.get(h, -1), i)
    want = []
    for i, _, h in given:
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        own = top[h] == i
        want.append((i, len(h), digest, "response" if own else "revisit", None if own else top[h]))
    assert sorted(tuple(r) for r in arc_warc.round_trip(pages).collect()) == sorted(want)
