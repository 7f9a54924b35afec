import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

import snapfeed as sf
from snapfeed.functions import element_category, page_text
from snapfeed.functions.text import PAGE_ENTITIES


def brute_chunks(text, size, overlap, max_chars):
    words = [w for w in re.split("[ \t\n\r]+", text) if w]
    if not words:
        return []
    stride = size - overlap
    number = 1 + max(0, math.ceil((len(words) - size) / stride))
    found = []
    for n in range(number):
        chunk = " ".join(words[n * stride : n * stride + size])
        pieces = [chunk[i : i + max_chars] for i in range(0, len(chunk), max_chars)]
        found += [(n, p, piece) for p, piece in enumerate(pieces)]
    return found


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    alphabet = ["a", "é", "日本", "😀", "longer", "x" * 40]
    gaps = [" ", "  ", "\n", "\t", "\r\n", " \n "]
    texts = ["", " \t\n\r ", "one", " one ", "\x0bodd\x0b space here"]
    for count in (1, 4, 5, 6, 7, 8, 9, 10, 11, 50, 300, 301, 1000):
        texts.append("".join(draw.choice(alphabet) + draw.choice(gaps) for _ in range(count)))
    return texts


@pytest.mark.parametrize(
    ("size", "overlap", "max_chars"),
    [(300, 10, 5000), (5, 2, 1000), (5, 0, 11), (3, 2, 7), (1, 0, 1), (7, 3, 40)],
)
def test_chunks_against_brute_force(spark, texts, size, overlap, max_chars):
    documents = spark.createDataFrame(list(enumerate(texts)), "id int, page_content string")
    chunks = sf.chunk_words(documents, size, overlap, max_chars)
    assert chunks.columns == ["id", "chunk_no", "piece_no", "chunk"]
    found = {}
    for row in chunks.collect():
        found.setdefault(row.id, []).append((row.chunk_no, row.piece_no, row.chunk))
    for number, text in enumerate(texts):
        assert sorted(found.get(number, [])) == brute_chunks(text, size, overlap, max_chars)


def test_a_null_text_has_no_chunk(spark):
    documents = spark.createDataFrame([(None,)], "page_content string")
    assert sf.chunk_words(documents).count() == 0


def test_arguments_of_chunks(spark):
    documents = spark.createDataFrame([("a",)], "page_content string")
    for arguments in ((5, 5), (5, 6), (5, -1), (5, 1, 0)):
        with pytest.raises(ValueError):
            sf.chunk_words(documents, *arguments)


def test_chunks_split_each_text_once_and_never_shuffle(spark, plan_of):
    documents = spark.range(3).select(F.col("id").cast("string").alias("page_content"))
    plan = plan_of(sf.chunk_words(documents))
    assert "Exchange" not in plan
    assert sum("split(" in line for line in plan.splitlines()) == 1


@pytest.mark.parametrize(
    ("line", "category"),
    [
        ("- item", "ListItem"),
        ("* item.", "ListItem"),
        ("12. item", "ListItem"),
        ("-item", "Title"),
        ("12.item", "Title"),
        ("x 1. item", "Title"),
        ("A title", "Title"),
        ("t" * 80, "Title"),
        ("t" * 81, "NarrativeText"),
        ("😀" * 80, "Title"),
        ("A sentence.", "NarrativeText"),
    ],
)
def test_categories(spark, line, category):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(element_category(F.col("line"))).first()[0] == category


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>one</p><p>two</p>", "one two"),
        ("a<script type='x'>\nif (a<b) {}\n</script>b", "a b"),
        ("a<style>p{}</style\n>b", "a p{} b"),
        ("a<!-- <b>x</b>\n-->b", "a b"),
        ("<a\nhref='x'>link</a>", "link"),
        ("x &lt;b&gt; &quot;q&quot; &#39;s&#39;&nbsp;&amp; y", "x <b> \"q\" 's' & y"),
        ("&amp;lt;", "&lt;"),
        (" \t\r\n one \n two ", "one two"),
        ("no markup", "no markup"),
        ("", ""),
    ],
)
def test_page_text(spark, html, text):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(page_text(F.col("html"))).first()[0] == text


def test_extracted_pages_keep_their_other_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")
    assert sf.extract_page_text(pages).first().asDict() == {"page_id": 1, "url": "u", "text": "x"}


def brute_page_text(html):
    for pattern in ("<script[^>]*>.*?</script>", "<style[^>]*>.*?</style>", "<!--.*?-->", "<[^>]*>"):
        html = re.sub(pattern, " ", html, flags=re.S)
    for reference, character in PAGE_ENTITIES:
        html = html.replace(reference, character)
    return re.sub("[ \t\n\r]+", " ", html).strip(" ")


def test_page_text_of_broken_pages(spark):
    draw = random.Random(11)
    parts = ["<script", "<script>", "</script>", "<style", ">", "</style>", "<!--", "-->", "-", "<!",
             "<p>", "a", "é", " ", "\n", "<", "&lt;", "$1", "\\"]
    pages = ["".join(draw.choice(parts) for _ in range(draw.randrange(14))) for _ in range(5000)]
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    found = df.select("id", page_text(F.col("html"))).collect()
    assert all(text == brute_page_text(pages[number]) for number, text in found)


@pytest.mark.parametrize("unit", ["<script>aa", "<script", "<!--aa", "<style a", "<"])
def test_page_text_takes_linear_time(spark, unit):
    def seconds(characters):
        page = unit * (characters // len(unit)) + "</script>"
        df = spark.createDataFrame([(page,)], "html string").select(F.length(page_text(F.col("html"))))
        df.first()
        start = time.perf_counter()
        df.first()
        return time.perf_counter() - start

    assert seconds(1_600_000) < 8 * seconds(200_000) * 2 + 1
