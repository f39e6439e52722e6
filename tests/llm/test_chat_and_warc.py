import hashlib
import zlib

import pytest
from compare import differences
from pyspark.sql import functions as F
from tests_data import SF_DIR

from pulseframe.llm import chat, queries, warc
from pulseframe.sources.staging import fresh_path


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    found, rows = differences(spark, con, name, queries.queries()[name], queries.oracle_sql()[name], SF_DIR)
    assert found is None
    assert rows > 0


# ---- op8


def messages(spark, rows):
    return spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")


def test_branches_are_ranked_by_score(spark):
    rows = [
        ("t", 1, None, "user", "root", 0.0),
        ("t", 2, 1, "assistant", "left", 1.0), ("t", 3, 1, "assistant", "right", 2.0),
        ("t", 4, 2, "user", "left leaf", 5.0), ("t", 5, 3, "user", "right leaf", 1.0),
        ("t", 6, 3, "user", "right leaf too", 1.0),
    ]
    best = chat.formatted(messages(spark, rows), branches=2).orderBy("rank").collect()
    assert [r["leaf"] for r in best] == [4, 5]  # 6 points, then 3 with the smaller leaf first
    assert best[0]["formatted"] == (
        "<turn user>\nroot\n</turn>\n<turn assistant>\nleft\n</turn>\n<turn user>\nleft leaf\n</turn>\n"
    )
    assert [best[0]["formatted"][s["start"]:s["end"]] for s in best[0]["loss_mask"]] == ["left"]


def test_cycles_orphans_and_long_chains(spark):
    rows = [("c", 1, 2, "user", "a", 0.0), ("c", 2, 1, "user", "b", 0.0), ("c", 3, 1, "user", "below", 0.0)]
    rows += [("o", 1, 99, "user", "orphan", None), ("o", 2, 1, None, None, None)]
    rows += [("l", n, n - 1 if n else None, "user", str(n), 1.0) for n in range(70)]
    found = {r["tree"]: r for r in chat.formatted(messages(spark, rows)).collect()}
    assert set(found) == {"o", "l"}
    assert found["o"]["formatted"] == "<turn user>\norphan\n</turn>\n<turn >\n\n</turn>\n"
    assert found["l"]["formatted"].count("<turn ") == 70
    assert found["l"]["formatted"].startswith("<turn user>\n0\n") and found["l"]["formatted"].endswith("\n69\n</turn>\n")


def test_null_scores_and_null_trees(spark):
    rows = [
        (tree, *rest) for tree in (None, "t")
        for rest in ((1, None, "user", "root", None), (2, 1, "user", "worse", -1.0), (3, 1, "user", "better", 5.0))
    ]
    found = {r["tree"]: r for r in chat.formatted(messages(spark, rows)).collect()}
    assert set(found) == {None, "t"}
    for r in found.values():
        assert r["leaf"] == 3 and r["formatted"] == "<turn user>\nroot\n</turn>\n<turn user>\nbetter\n</turn>\n"


def test_edge_conversations(spark):
    odd = "a</turn>\n<turn assistant>\nb &lt; &amp;amp; \\ 🙂"
    rows = [
        (1, 0, "assistant", odd, "x"), (1, 0, "assistant", odd, "x"), (1, None, None, None, "x"), (None, 0, "assistant", "solo", "x"),
        (2, 3, "user", "", "x"), (3, 0, "as>sis\ntant", "z" * 100_000, "x"),
    ]
    schema = "conv_id long, turn long, role string, text string, tree string"
    got = {r["conv_id"]: r for r in chat.conversation_digests(spark.createDataFrame(rows, schema)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[1]["n_turns"] == 3
    assert got[1]["turns_sha256"] == sha("\n\n" + f"assistant\n{odd}\n" * 2)
    assert got[1]["loss_sha256"] == sha(odd * 2) and got[1]["loss_chars"] == 2 * len(odd)
    assert got[None]["loss_sha256"] == sha("solo")
    assert got[2]["loss_chars"] == 0 and got[2]["turns_sha256"] == sha("user\n\n")
    assert got[3]["turns_sha256"] == sha("as>sis\ntant\n" + "z" * 100_000 + "\n")
    assert chat.conversation_digests(spark.createDataFrame([], schema)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = queries.op8_chat_format(spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- op10

PAGES = "page_id long, url string, html string, key string, size string"


def archive(spark, rows):
    return {(r["page_id"], r["payload_digest"]): r for r in warc.archive_pages(spark, spark.createDataFrame(rows, PAGES)).collect()}


def test_revisits_and_edge_pages(spark):
    big, small = "é" * 60, "s" * 99
    rows = [
        (5, "http://A.example.com/x", big, "k", "1"), (3, "http://a.example.com/x", big, "k", "1"),
        (9, "https://b.example.org/", big, "k", "1"), (9, "https://b.example.org/", big, "k", "1"),
        (1, "http://c/", small, "k", "1"), (2, "http://c/", small, "k", "1"), (4, None, None, "k", "1"), (6, "no scheme", "", "k", "1"),
        (None, "http://d/\r\nInjected: yes", big, "k", "1"), (7, "http://long/", "y" * 300_000, "k", "1"), (8, "http://odd/", "a\r\n\r\nWARC/1.1\r\n", "k", "1"),
    ]
    found = warc.archive_pages(spark, spark.createDataFrame(rows, PAGES)).collect()
    assert len(found) == len(rows)
    digest = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    got = {r["page_id"]: r for r in found}
    for page, _, html, _, _ in rows:
        assert got[page]["payload_bytes"] == len((html or "").encode())
        assert got[page]["payload_digest"] == digest(html)
    assert {p for p, r in got.items() if r["record_type"] == "revisit"} == {5, 9, None}
    assert all(got[p]["refers_to"] == 3 for p in (5, 9, None))
    assert got[1]["refers_to"] is None and got[3]["refers_to"] is None
    assert sum(r["page_id"] == 9 for r in found) == 2
    assert warc.archive_pages(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_index_over_many_blocks(spark):
    n = 3 * warc.BLOCK_LINES + 17
    pages = spark.range(n).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://hot.example.com/"), F.col("id") % 7).alias("url"),
        F.col("id").cast("string").alias("html"),
    )
    path = fresh_path(spark, "archive")
    captures = warc.write_archive(pages, path)
    index = warc.write_index(captures, path)
    assert index.agg(F.sum("lines")).collect()[0][0] == n
    reader = warc.Reader(warc.file_list(index))
    for page in (0, 1, 6, n - 1, n // 2):
        (where,) = reader.captures(f"com,example,hot)/{page % 7}", page)
        fields, payload = reader.record(*where)
        assert payload == str(page).encode() and fields["WARC-Type"] == "response"
    assert not list(reader.captures("com,example,hot)/0", 1)) and not list(reader.captures("zzz", 0))
    missing = pages.select((F.col("page_id") + 1).alias("page_id"), "url")
    assert warc.look_up(missing, index).count() == 0


def test_archives_are_plain_warc(spark):
    path = fresh_path(spark, "archive")
    rows = [(1, "http://x/", "p" * 200, "k", "1"), (2, "http://x/", "p" * 200, "k", "1")]
    captures = warc.write_archive(spark.createDataFrame(rows, PAGES).coalesce(1), path)
    (file,) = {r["file"] for r in captures.collect()}
    fs, local = warc.opened(file)
    data, heads = fs.open_input_stream(local, compression=None).read(), []
    while data:
        member = zlib.decompressobj(31)
        heads.append(member.decompress(data))
        data = member.unused_data
    assert [h.startswith(b"WARC/1.1\r\n") and h.endswith(b"\r\n\r\n") for h in heads] == [True, True]
    assert sorted(b"WARC-Type: revisit" in h for h in heads) == [False, True]


@pytest.mark.parametrize(("url", "key"), [
    ("https://WWW.Example.com/a?b#c", "com,example,www)/a?b"), ("http://x", "x)"), (None, ""), ("no scheme", "no scheme)"), ("", ""),
])
def test_url_keys(spark, url, key):
    row = spark.createDataFrame([(url,)], "url string").select(warc.url_key(F.col("url")).alias("k")).collect()[0]
    assert row["k"] == key
