import base64
import gzip
import hashlib
import io

from pyspark.sql import types as T

from ratecraft.llm import warc

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("original", T.LongType()),
    ]
)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", 1) for r in rows], PAGES).repartition(3)


ROWS = [
    (1, "http://a/1", "<p>é one</p>"),
    (2, "http://a/2", "<p>é one</p>"),
    (3, None, None),
    (4, "http://a/4\r\nX: y", ""),
    (5, "http://a/5", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (6, "http://a/6", "<p>é one</p>"),
    (6, "http://a/6", "<p>é one</p>"),
    (7, "http://a/7", "x" * 1_500_000),
    (8, "http://a/8", "x" * 1_500_000),
    (None, "http://a/n", "<p>é one</p>"),
    (1, "http://a/1", "<p>é one</p>"),
]


def brute(rows, least=0):
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "").encode() == body]
        first = min(same, default=None)
        again = len(body) >= least and page is not None and page > first
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def collected(df):
    return sorted(
        ((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str
    )


def test_round_trip(spark):
    assert collected(warc.deduplicate(pages(spark, ROWS))) == brute(ROWS)
    assert collected(warc.deduplicate(pages(spark, ROWS), least_bytes=5)) == brute(ROWS, 5)
    assert warc.deduplicate(pages(spark, [])).count() == 0


def test_archives(spark, tmp_path):
    folder = str(tmp_path / "w")
    df = pages(spark, ROWS).coalesce(1)
    listed = warc.write(df, folder, archive_bytes=600).collect()
    names = {p.name for p in (tmp_path / "w").glob("*.warc.gz")}
    assert names == {r["archive"] for r in listed} and len(names) > 1
    assert sum(r["records"] for r in listed) == len(ROWS)
    before = {n: (tmp_path / "w" / n).read_bytes() for n in names}
    warc.write(df, folder, archive_bytes=600)  # a repeated attempt writes the same bytes
    assert {n: (tmp_path / "w" / n).read_bytes() for n in names} == before
    recs = [r for n in names for r in warc.parse(io.BytesIO(gzip.decompress(before[n])))]
    texts = sorted((h or "").encode() for _, _, h in ROWS)
    kept = [r["block"].partition(b"\r\n\r\n")[2] for r in recs if r["warc-type"] == "response"]
    assert set(kept) == set(texts)
    ids = {r["warc-record-id"] for r in recs if r["warc-type"] == "response"}
    assert all(r["warc-refers-to"] in ids for r in recs if r["warc-type"] == "revisit")
