import base64
import hashlib

from logsift.llm.warc import END, MAGIC, read_archives, warc_round_trip, write_archives
from logsift.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, file string"


def brute(rows, least=0):
    groups = {}
    for i, (p, u, h) in enumerate(rows):
        h = (h or "").encode()
        groups.setdefault(h if len(h) >= least else (i, h), []).append((p is not None, p or 0, u or "", i, p))
    out = []
    for h, g in groups.items():
        h = h if isinstance(h, bytes) else h[1]
        top = max(g)
        for x in g:
            out.append((x[4], len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "response" if x == top else "revisit",
                        None if x == top else top[4]))
    return sorted(map(str, out))


FAKE = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc{END}"
ROWS = [(1, "u", "<p>a</p>"), (5, "u", "<p>a</p>"), (3, None, "<p>a</p>"), (2, "v\r\nx y", None), (4, "", ""), (6, "u", "é日本\r\n\r\nend\r\n"),
        (7, "w", "before" + FAKE + "after"), (8, "w", FAKE), (9, "w", MAGIC), (10, "w", MAGIC + MAGIC + "x"), (11, "w", END * 3),
        (12, "w", "x" * 300_000), (12, "w", "x" * 300_000), (None, "n", "null id"), (13, "z", FAKE[:-1]), (14, "z", "WARC/1.1\r"),
        (15, "z", FAKE + FAKE.replace("99", "98"))]


def test_round_trip_equals_brute_force_with_magic_in_payloads(spark):
    rows = ROWS + [(100 + i, "u", f"page {i % 40} " * (i % 17)) for i in range(300)]
    df = spark.createDataFrame([(*r, "d", "f") for r in rows], SCHEMA).repartition(3)
    for least in (0, 9):
        out = warc_round_trip(df, min_bytes=least)
        assert out.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        assert sorted(str(tuple(r)) for r in out.collect()) == brute(rows, least)


def test_split_files_read_the_same(spark):
    df = spark.createDataFrame([(*r, "d", "f") for r in ROWS], SCHEMA).coalesce(1)
    path = write_archives(df, scratch_path(spark, "warc-test"))
    whole = sorted(map(str, read_archives(spark, path).drop("file").collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert sorted(map(str, read_archives(spark, path).drop("file").collect())) == whole and len(whole) == len(ROWS)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_empty_table(spark):
    assert warc_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
