"""Queries with SQL, whole results against it; edge cases of the two native operators."""

import duckdb
import pytest

from brasa.llm import licenses, warc
from brasa.llm.registry import ORACLES, QUERIES
from helpers_llm import SF_SMALL, frame, groups_fixture  # noqa: F401
from tools.compare import digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF_SMALL), con.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert digest(got.columns, [tuple(r) for r in got.collect()])[0] == digest(want.columns, want.fetchall())[0]


def against_sql(table, rows, columns, sql, got):
    c = duckdb.connect()
    c.execute(f"CREATE TABLE {table} ({columns})")
    if rows:
        c.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    want = c.sql(sql)
    assert digest(got.columns, [tuple(r) for r in got.collect()])[0] == digest(want.columns, want.fetchall())[0]


def test_license_edge_cases(spark, frame):
    texts = [None, "", "cc by", "CC\nBY cc by-nc", "All rights\treserved. all rights reserved", "cc " * 5000 + "by",
             "Licensed under the Apache License, Version 2.0.", "licensed under the apache license", "released under mit",
             "general public license " * 3, chr(0x212A) + " cc by" + chr(0xC9) + " cc by", "x" * 100_000, "license " * 500,
             "This work is licensed\nunder the GNU General Public License, version 3", "by cc", "İ cc by ı",
             "Redistribution and use in source and binary forms, with or without\nmodification, are permitted",
             "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software",
             "word " * 61 + "Released under\nthe MIT License" + " word" * 7, "mit " + "word " * 20 + "released under the license"]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    docs = frame(rows, "doc_id long, text string, held string")
    against_sql("documents", rows, "doc_id BIGINT, text VARCHAR, held VARCHAR", licenses.ORACLE, licenses.scan(spark, docs))


def test_license_rows_are_kept(spark, frame):
    docs = frame([(None, "Released under the MIT License"), (None, "Released under the MIT License"), (1, None)],
                 "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["labels"], r["score"]) for r in licenses.scan(spark, docs).collect())
    assert got == [(0, "mit", 1.0), (0, "mit", 1.0), (1, "", 0.0)]
    assert licenses.scan(spark, frame([], "doc_id long, text string")).collect() == []


def test_thresholds_are_exact(spark, frame):
    templates = (("t", "a b c d e"),)
    docs = frame([(1, "a b c d"), (2, "a b c"), (3, "x\ne d c b\ny"), (4, "a b\nc d e")], "doc_id long, text string")
    for threshold, want in ((0.8, {1, 3, 4}), (0.6, {1, 2, 3, 4}), (1.0, {4})):
        got = licenses.scan(spark, docs, templates=templates, threshold=threshold, phrases={"zz zz": "z"}).collect()
        assert {r["doc_id"] for r in got if r["labels"] == "t"} == want


def test_templates_are_found_wherever_they_stand(spark, frame):
    """Each template, its words broken over lines, behind any number of other words; its words spread far apart aren't it."""
    rows = [(100 * t + k, "other\n" * k + body.replace(" ", "\n" if k % 2 else " \r\n ") + " words" * k)
            for t, (_, body) in enumerate(licenses.TEMPLATES) for k in (0, 1, 5, 8, 13, 31, 40)]
    got = {r["doc_id"]: r for r in licenses.scan(spark, frame(rows, "doc_id long, text string")).collect()}
    for doc_id, _ in rows:
        assert licenses.TEMPLATES[doc_id // 100][0] in got[doc_id]["labels"].split(","), doc_id
        assert got[doc_id]["score"] == 1.0
    apart = [(t, (" word" * 40).join(body.split())) for t, (_, body) in enumerate(licenses.TEMPLATES)]
    got = licenses.scan(spark, frame(apart, "doc_id long, text string"), phrases={"zz zz": "z"}).collect()
    assert {(r["labels"], r["score"]) for r in got} == {("", 0.0)}


def archive(spark, tmp_path, pages, **options):
    path = str(tmp_path / "archive")
    warc.write_archive(spark, pages, path, **options)
    return path


def test_archive_round_trip(spark, frame, tmp_path):
    rows = [(1, "http://a", "x", 0), (2, None, "x", 0), (3, "u\r\nInjected: 1", None, 0), (4, "u", "", 0), (None, "n", "x", 0),
            (5, "é", "é\r\n\r\nWARC/1.1", 0), (6, "b", "y" * 200_000, 0), (2, "again", "x", 0), (None, "alone", "z", 0)]
    pages = frame(rows, "page_id long, url string, html string, digest int")
    path = archive(spark, tmp_path, pages)
    payloads = spark.read.parquet(f"{path}/payloads").collect()
    assert sorted(bytes(r["payload"]) for r in payloads) == sorted({(h or "").encode() for _, _, h, _ in rows})
    records = [(r["header"], bytes(r["payload"])) for r in warc.read_records(spark, path).collect()]
    assert sorted(p for _, p in records) == sorted((h or "").encode() for _, _, h, _ in rows)
    types = sorted((h.split("<urn:page:")[1].split(">")[0], h.split("WARC-Type: ")[1].split("\r")[0]) for h, _ in records)
    assert types == [("1", "revisit"), ("2", "response"), ("2", "response"), ("3", "revisit"), ("4", "response"),
                     ("5", "response"), ("6", "response"), ("null", "response"), ("null", "revisit")]
    assert not any("\nInjected" in h for h, _ in records)
    whole = [bytes(r["record"]) for r in warc.record_bytes(warc.read_records(spark, path)).collect()]
    assert sorted(whole) == sorted(h.encode() + p + b"\r\n\r\n" for h, p in records)


def test_archive_least_size_and_empty(spark, frame, tmp_path):
    schema = "page_id long, url string, html string"
    path = archive(spark, tmp_path, frame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long"), (4, "d", "long")], schema),
                   min_bytes=3)
    heads = [r["header"] for r in warc.read_records(spark, path).collect()]
    assert sum("WARC-Type: revisit" in h for h in heads) == 1 and len(heads) == 4
    empty = archive(spark, tmp_path / "none", frame([], schema))
    assert warc.read_records(spark, empty).collect() == []


def test_a_damaged_payload_is_found(spark, frame, tmp_path):
    path = archive(spark, tmp_path, frame([(1, "a", "xy")], "page_id long, url string, html string"))
    damaged = spark.read.parquet(f"{path}/payloads").selectExpr("digest", "response_id", "cast('zz' as binary) as payload")
    rows = damaged.collect()
    spark.createDataFrame(rows, damaged.schema).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not match"):
        warc.read_records(spark, path).collect()
