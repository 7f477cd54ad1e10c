import base64
import hashlib
import random

import pytest

from lithos.llm import warc


def pages():
    rnd = random.Random(2)
    rows = [(i, f"http://x.example/{i} é\n", "<p>" + " ".join(rnd.choices(["ab", "é", "<b>"], k=rnd.choice([0, 3, 900])))) for i in range(80)]
    rows += [(100 + i, None, rows[i][2]) for i in range(10)] + [(200, "u", None), (201, "u", ""), (150, "u", rows[3][2]), (150, "u", rows[3][2]), (9, "u", "other text under a used id")]
    return rows + [(None, "u", rows[3][2]), (None, "n", "alone"), (300, "u", "Content-Length: 5\r\n\r\n" * 3)]


def brute(rows, least=0):
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        ids = groups[h or ""]
        target = max([x for x in ids if x is not None], default=None)
        first = len(b) < least or target is None or i == target or len(ids) == 1
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first else "revisit", None if first else target))
    return sorted(out, key=str)


@pytest.mark.parametrize("least,size", [(0, 8 << 20), (50, 3000)])
def test_round_trip(spark, least, size):
    rows = pages()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, sha1 string, target long")
    archives = warc.write_archives(df, min_revisit_bytes=least, archive_bytes=size).cache()
    back = warc.read_archives(archives).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back], key=str) == brute(rows, least)
    texts = {(i, len((h or "").encode())): (h or "").encode() for i, _, h in rows}
    assert all(bytes(r.payload) == texts[r.page_id, r.payload_bytes] for r in back if r.record_type == "response")
    assert all(r.payload is None for r in back if r.record_type == "revisit")
    assert archives.agg({"n_records": "sum"}).first()[0] == len(rows)


def test_archive_layout():
    records = [f"record {i} with much the same words in it, again and again, {i * 7919}".encode() * 3 for i in range(400)]
    content = warc.compress(records)
    assert content[:4] == (0x184D2A5D).to_bytes(4, "little") and int.from_bytes(content[4:8], "little") > 0
    assert list(warc.decompress(content)) == records
    assert list(warc.decompress(warc.compress([b"", b"a"]))) == [b"", b"a"]
    with pytest.raises(ValueError):
        list(warc.decompress(content[:-3]))


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a"), (2, "u", "b")], "page_id long, url string, html string").coalesce(1)
    warc.export(warc.write_archives(df), str(tmp_path))
    files = list(tmp_path.glob("*.warc.zst"))
    assert sorted(warc.parse(r)[0] for f in files for r in warc.decompress(f.read_bytes())) == [1, 2]


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(df)).count() == 0
