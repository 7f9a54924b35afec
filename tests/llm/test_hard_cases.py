"""Inputs that once failed or never ended: full forms, long items, clashing names."""

import re
import time

import pytest

from snapfeed.llm import pii
from snapfeed.llm.common import free, without
from snapfeed.llm.decontam import fingerprint, judge_contamination
from snapfeed.llm.html_blocks import leaf_blocks
from snapfeed.llm.html_crf import Field, extract_text
from snapfeed.llm.mixing import mixed_documents
from snapfeed.llm.urls import judge_urls


def texts(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_mail_addresses_that_leave_no_room(spark):
    docs = texts(spark, "to _@Example.com", "to _@example.com", "to _@-.ab", "a@Example.com a@EXAMPLE.com A@example.com", "b_@example.com")
    got = [row.text for row in pii.replace_entities(docs, "k").orderBy("doc_id").collect()]
    assert got[0] == got[1] != "to _@example.com"
    assert "_@-.ab" not in got[2] and re.fullmatch(r"to \S+@-\.ab", got[2])
    small, again, large = got[3].split()
    assert small == again != large
    found = [x for text in got for x in re.findall(r"\S+@\S+", text)]
    assert len(set(found)) == 5


def test_more_names_than_short_ones(spark):
    """70,000 names of one word, script and gender: there are 64,000 short surrogates."""
    names = spark.range(70_000).selectExpr("'name m' as kind", "concat('N', lower(conv(id, 10, 26)), 'x') as value")
    settled = pii.settle_collisions(names, "k")
    real = names.withColumnRenamed("value", "surrogate")
    assert settled.select("surrogate").distinct().count() == settled.count() == names.distinct().count()
    assert settled.join(real, "surrogate", "left_semi").count() == 0


def test_a_form_without_room_is_permuted(spark, monkeypatch):
    """Every address of a private network occurs: none is free for another."""
    monkeypatch.setattr(pii, "ROUNDS", 2)
    every = spark.range(1 << 16).selectExpr("'ip' as kind", "concat('192.168.', id div 256, '.', id % 256) as value")
    others = spark.createDataFrame([("ip", "8.8.8.8"), ("phone", "+1 523 555 7040"), ("email", "a@b.cd")], "kind string, value string")
    settled = pii.settle_collisions(every.unionAll(others), "k").collect()
    assert len({row.surrogate for row in settled}) == len(settled) == (1 << 16) + 3
    assert sum(row.surrogate.startswith("192.168.") for row in settled) == 1 << 16
    assert all(row.attempt == 0 for row in settled if row.surrogate.startswith("192.168."))


def test_long_benchmark_items(spark):
    equal, different = "same " * 33_000, " ".join(f"w{i}" for i in range(70_000))
    docs = texts(spark, "a clean one of some words", "lead " + different + " tail", equal, None)
    items = spark.createDataFrame([(1, equal), (2, different)], "item_id long, text string")
    got = {row.doc_id: row["items"] for row in judge_contamination(docs, items).collect()}
    assert got == {0: [], 1: [2], 2: [1], 3: []}


def test_fingerprints_count_every_bit(spark):
    rows = spark.createDataFrame([(["a"],), (["a", "b", "c"],), (["x"] * 70_000,), ([],)], "s array<string>")
    got = rows.select(fingerprint("s").alias("f"), "s").collect()
    for row in got:
        hashes = [r.h & (1 << 64) - 1 for r in spark.createDataFrame([(x,) for x in row.s[:3]] or [("",)], "x string").selectExpr("xxhash64(x) as h").collect()]
        n = len(row.s[:3])
        wanted = sum(1 << b for b in range(64) if n and 2 * sum(h >> b & 1 for h in hashes) > n)
        assert row.f & (1 << 64) - 1 == wanted


def test_free_names():
    assert free(["a", "B", "b_"], "A", "b", "c") == ["A_", "b__", "c"]


@pytest.mark.parametrize("name", ["own_key", "g_id", "g_key", "m_id", "m_key", "m_no", "raw_text", "odd_entities", "odd_id", "key"])
def test_clashing_names(spark, name):
    rows = [(1, "call +1 (523) 555-7040 now", "s", "x"), (2, "words of a text", None, "y"), (None, None, "s", None)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source string, {name} string")
    gone = spark.sql("select 2L as doc_id, xxhash64(2L, 'words of a text') as key")
    assert sorted(map(str, without(docs, gone).collect())) == sorted(map(str, docs.where("doc_id <=> 1 or doc_id is null").collect()))
    mixed = mixed_documents(docs)
    assert mixed.columns[:4] == docs.columns
    assert {row[name] for row in mixed.collect()} <= {"x", "y", None}
    replaced = pii.replace_entities(docs, "k")
    assert replaced.columns == [*docs.columns, "n_entities"]
    assert sorted((row[name] or "", row.n_entities) for row in replaced.collect()) == [("", 0), ("x", 1), ("y", 0)]


def test_hosts_of_many_labels(spark):
    """40,000 labels: only suffixes of a rule's number of labels are made."""
    host = "a." * 40_000 + "com"
    pages = spark.createDataFrame([(1, f"http://{host}/de/x"), (2, f"http://b.{host}./de/"), (3, "x://" + "." * 50_000)], "page_id long, url string")
    rules = spark.createDataFrame([("block", "a.com", "/de/"), ("block", "com", "/"), ("block", "", "")], "action string, host string, path string")
    judge_urls(pages.limit(1), rules).count()
    start = time.time()
    got = {row.page_id: row.rule for row in judge_urls(pages, rules).collect()}
    assert got == {1: "a.com/de/", 2: "", 3: ""}
    assert time.time() - start < 20


@pytest.mark.parametrize("name", ["u_url", "U_RULE", "u_verdict", "short", "digest", "best", "labels", "n"])
def test_urls_with_clashing_names(spark, name):
    rows = [(1, "http://x.com/de/", "a"), (2, None, "b"), (1, "http://x.com/de/", "a")]
    pages = spark.createDataFrame(rows, f"page_id long, url string, {name} string")
    rules = spark.createDataFrame([("block", "com", "/de/")], "action string, host string, path string")
    got = judge_urls(pages, rules)
    assert got.columns == ["page_id", "url", name, "host", "path", "rule", "verdict"]
    assert sorted((row[name], row.verdict) for row in got.collect()) == [("a", "block"), ("a", "block"), ("b", "allow")]


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ('<p title="a > b">Hello world</p>', ["Hello world"]),
        ('<p data-x="</p>">hey</p>', ["hey"]),
        ("<p data-x = '<b>\"</b>' id=x>one</p><p>two</p >", ["one", "two"]),
        ("<script data-x='a > b'>var x</script>text", ["text"]),
        ("<p>it's a <a title=\"1 > 0\">link</a> isn't it</p>", ["it's a link isn't it"]),
        ('<p title="never closed>one</p><p>two</p>', ["one", "two"]),
        ("<p a=b\">one</p>", ["one"]),
    ],
)
def test_quoted_signs(page, texts):
    assert [block.text for block in leaf_blocks(page)] == texts


def test_quotes_take_linear_time():
    start = time.time()
    for broken in ('<p a=">" ', "<p a=\"'>", "<p a=' ", '<p a="<p>"=', '="', "<p ='\"> "):
        leaf_blocks("<p>" + broken * 200_000)
    assert time.time() - start < 20


@pytest.mark.parametrize("name", ["raw_html", "RAW_HTML", "tag"])
def test_pages_with_clashing_names(spark, name):
    field = Field({}, [[0.0, 0.0], [0.0, 0.0]])
    pages = spark.createDataFrame([(1, "<p>x</p>", "a"), (2, None, "b")], f"page_id long, html string, {name} string")
    got = extract_text(pages, field)
    assert got.columns == ["page_id", name, "text", "n_chars"]
    assert sorted(row[name] for row in got.collect()) == ["a", "b"]
