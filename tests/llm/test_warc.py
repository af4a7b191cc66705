import hashlib
import io
import struct

import zstandard
from pyarrow import fs as pafs

from noteledger.llm import warc as WA


def test_round_trip_and_revisits(spark):
    big = "<html>" + "x" * 200 + "</html>"
    rows = [(1, "http://a/1", "<p>" + "hello " * 30 + str(i) + "</p>") for i in range(2)]
    rows += [(i, f"http://b/{i}%41\r\nX: y", big) for i in (9, 4, 6, 4)] + [(None, None, big), (50, "u", None), (51, "u", ""), (52, "é", "short"), (53, "é", "short"), (54, "v", "é" * 60_000 + "\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame([(i, u, h, "d") for i, u, h in rows], "page_id long, url string, html string, payload_digest string")
    archives = WA.write_warc(pages, WA.warc_folder(spark)).collect()
    assert sum(a.n_records for a in archives) == len(rows)
    got = WA.read_warc(spark.createDataFrame(archives)).collect()
    assert sorted((str(r.page_id), str(r.url)) for r in got) == sorted((str(i), str(u)) for i, u, _ in rows)
    for r in got:
        body = big if r.payload is None else r.payload.decode()
        assert r.payload_bytes == len(body.encode()) and r.payload_digest == hashlib.sha256(body.encode()).hexdigest()
    copies = [r for r in got if r.payload_bytes == len(big)]
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in copies) == [
        ("4", "response", None), ("4", "response", None), ("6", "revisit", 4), ("9", "revisit", 4), ("None", "revisit", 4)]
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 100)


def test_dictionary_frame(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<html><head><title>page {i}</title></head><body>" + f"<p>row {i % 7} of many</p>" * (i % 30) + "</body></html>") for i in range(400)],
                                  "page_id long, url string, html string").coalesce(1)
    (archive,) = WA.write_warc(pages, WA.warc_folder(spark)).collect()
    system, name = pafs.FileSystem.from_uri(archive.path)
    data = system.open_input_file(name).read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and struct.unpack("<I", data[8:12])[0] == 0xEC30A437  # a trained dictionary
    # a stock reader with that dictionary reads frame after frame
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    whole = reader.stream_reader(io.BytesIO(data[8 + size:]), read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 401  # with the warcinfo
    plain = sum(len(zstandard.compress(x)) for x in whole.split(b"WARC/1.1")[1:])
    assert len(data) - 8 - size < plain


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    archives = spark.createDataFrame(WA.write_warc(pages, WA.warc_folder(spark)).collect(), WA.ARCHIVES)
    assert WA.read_warc(archives).count() == 0


def rows_of(bodies):
    import pandas as pd

    rows = [(i, "u", "response", None, hashlib.sha256(b).hexdigest(), len(b), b, False) for i, b in enumerate(bodies)]
    return pd.DataFrame(rows, columns=[*WA.RECORD_COLUMNS, "named"])


def stored_file(archive):
    system, name = pafs.FileSystem.from_uri(archive.path[0])
    return system.open_input_file(name).read()


def test_every_file_has_a_dictionary(spark):
    page = lambda i, n: b"<html>" + b"".join(b"<p>row %d of %d</p>" % (j, i) for j in range(n))
    cases = [[b"x" * (5 << 20), *[page(i, 30) for i in range(200)]], [page(i, 20_000) for i in range(40)], [b"tiny"], [b""], [b"same"] * 50]
    for bodies in cases:
        (archive,) = WA.write_archive(WA.warc_folder(spark), iter([rows_of(bodies)]))
        data = stored_file(archive)
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D and size > 0
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
        whole = reader.stream_reader(io.BytesIO(data[8 + size:]), read_across_frames=True).read()
        assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        got = list(WA.read_archive(archive.path[0]))
        assert [r["payload"] for r in got] == bodies and archive.n_records[0] == len(bodies)


def test_training_sees_whole_records_in_slices(spark, monkeypatch):
    seen = []
    real = WA.train
    monkeypatch.setattr(WA, "train", lambda records: (seen.extend(records), real(records))[1])
    body = [b"a" * 300_000 + str(i).encode() for i in range(20)] + [b"b" * (5 << 20)]
    assert [x.n_records[0] for x in WA.write_archive(WA.warc_folder(spark), iter([rows_of(body)]))] == [21]
    assert sum(map(len, seen)) == WA.SAMPLE_BYTES and all(WA.parse(x)["payload"] == body[i] for i, x in enumerate(seen[:-1]))


def headers(spark, archives):
    out = []
    for a in archives:
        data = pafs.FileSystem.from_uri(a.path)[0].open_input_file(pafs.FileSystem.from_uri(a.path)[1]).read()
        size = struct.unpack("<II", data[:8])[1]
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
        whole = reader.stream_reader(io.BytesIO(data[8 + size:]), read_across_frames=True).read()
        out += [dict(line.split(b": ", 1) for line in part.split(b"\r\n\r\n")[0].split(b"\r\n")[1:]) for part in whole.split(b"WARC/1.1\r\n") if part for part in [b"\r\n" + part]]
    return out


def test_record_ids_are_unique_and_referred_to(spark, monkeypatch):
    big, twice = "<html>" + "x" * 200, "<html>" + "y" * 200
    rows = [(i, f"u{i}", big) for i in (4, 9, 6)] + [(i, "v", "small") for i in (10, 11, 11)] + [(20, "w", twice), (20, "w", twice), (21, "w", twice), (None, "n", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for small in (WA.SMALL, -1):
        monkeypatch.setattr(WA, "SMALL", small)
        found = headers(spark, WA.write_warc(pages, WA.warc_folder(spark)).collect())
        ids = [h[b"WARC-Record-ID"] for h in found]
        assert len(set(ids)) == len(ids)
        by_page = {h.get(b"WARC-X-Page-ID"): h for h in found}
        revisits = [h for h in found if h[b"WARC-Type"] == b"revisit"]
        assert sorted(h.get(b"WARC-X-Page-ID", b"") for h in revisits) == [b"", b"21", b"6", b"9"]
        for h in revisits:
            if h[b"WARC-X-Refers-To-Page-ID"] == b"4":
                assert h[b"WARC-Refers-To"] == by_page[b"4"][b"WARC-Record-ID"]
            else:  # two responses repeat page 20
                assert b"WARC-Refers-To" not in h


def test_payloads_are_not_shuffled(spark):
    pages = spark.createDataFrame([(i, "u", "p" * 300) for i in range(50)], "page_id long, url string, html string")
    marked = WA.mark_revisits(pages, "page_id", "url", "html", 100)
    assert "Exchange hashpartitioning" not in marked._jdf.queryExecution().executedPlan().toString()


def test_folder_has_the_scheme_of_its_file_system(spark):
    assert WA.warc_folder(spark).startswith("file:///")
