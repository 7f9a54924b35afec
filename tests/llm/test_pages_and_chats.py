"""Extraction, url rules and chat formatting against brute force and round trips."""

import hashlib
import time

import pytest

from snapfeed.llm.chat import conversation_digests, escape, format_conversations, unescape
from snapfeed.llm.html_blocks import leaf_blocks
from snapfeed.llm.html_crf import default_field, extract_text, labelled, main_text
from snapfeed.llm.html_labelled import labelled_pages
from snapfeed.llm.template import TemplateError, compile_template
from snapfeed.llm.urls import RULES, judge_urls, rules_table


@pytest.fixture(scope="module")
def crf():
    return default_field()


def test_field_on_held_out_pages(crf):
    blocks = wrong = 0
    for page, texts in labelled_pages(150, 77):
        found, labels = labelled(page, texts)
        said = crf.decode([crf.score(block) for block in found])
        blocks += len(found)
        wrong += sum(bool(a) != b for a, b in zip(labels, said, strict=True))
    assert wrong < 0.01 * blocks


PAGE = """<html><head><title>T</title></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div class="ad">Buy this now.</div><article><h1>Head &amp; line</h1><p><b>Caf&eacute;&nbsp; and
 more of it, said at length.<br><p>Second <a href=y>paragraph</a> of the text, in full.</p>
<!-- no --><script>var a = "</p>";</script></article>
<section class="comments"><p>I do not agree at all.</p></section><footer>&copy; site</footer>"""


def test_extract(spark, crf):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", None), (4, "u", "<p", "x"), (1, "u", PAGE, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {row.page_id: row for row in extract_text(pages, crf).collect()}
    assert got[1].text == "Head & line\nCafé and more of it, said at length.\nSecond paragraph of the text, in full."
    assert got[1].n_chars == len(got[1].text)
    assert [got[i].text for i in (2, 3, 4)] == ["", "", ""]
    assert extract_text(pages, crf).columns == ["page_id", "url", "text", "n_chars"]
    assert extract_text(pages.limit(0), crf).count() == 0


def test_broken_pages_take_linear_time(crf):
    known = crf.known()
    for part in ("<script>", "<div>", "<p>a</div>", "<!--", "<a", '<div class="menu', "<b>x", "&amp"):
        start = time.perf_counter()
        main_text(part * 25_000, crf, known)
        assert time.perf_counter() - start < 5
    assert [b.text for b in leaf_blocks("a < b <p>c")] == ["a < b", "c"]


URLS = [
    "http://a.example.org/es/1", "HTTPS://EXAMPLE.ORG/en/17?x#y", "http://example.org/en/2", "http://x.com/fr/", "x.com/fr/",
    "http://x.com/de/a://b", None, "", "http://notorg/", "http://org", "http://xcom/de/", "http://a.b.example.org?/es/", "://",
]


def test_urls(spark):
    def judged(url):
        rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
        ends = [k for k in (rest.find(c) for c in "/?#") if k >= 0]
        host = rest[: min(ends)] if ends else rest
        path = rest[len(host) :].split("?")[0].split("#")[0]
        host = host.lower()
        fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        return host, path, best and best[1] + best[2], best[0] if best else "allow"

    rows = [(i, url, "h", 5) for i, url in enumerate([*URLS, URLS[0]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule int")
    got = judge_urls(pages, rules_table(spark))
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    for row in got.collect():
        assert (row.host, row.path, row.rule, row.verdict) == judged(row.url)
    assert got.count() == len(rows)
    assert judge_urls(pages.limit(0), rules_table(spark)).count() == 0
    assert judge_urls(pages, rules_table(spark).limit(0)).where("verdict = 'allow' and rule is null").count() == len(rows)


def test_templates():
    render = compile_template(
        "{% for m in messages %}{{ loop.index }}{% if m.role == 'a' and not loop.last %}A{% elif loop.last %}L"
        "{% else %}{{ 'o' + 'p' }}{% endif %}{% generation %}{{ m['text']|up }}{% endgeneration %}{% endfor %}",
        {"up": lambda x: str(x).upper()},
    )
    pieces = list(render({"role": r, "text": r * 2} for r in "abc"))
    assert "".join(text for text, _ in pieces) == "1AAA2opBB3LCC"
    assert [text for text, marked in pieces if marked] == ["AA", "BB", "CC"]
    for wrong in ("{% if x %}", "{{ a() }}", "{{ x.__class__.y() }}", "{% endfor %}", "{{ a|nofilter }}", "{{ }}", "{{ [1] }}"):
        with pytest.raises(TemplateError):
            compile_template(wrong)
    assert list(compile_template("{{ x.__class__ }}")([], x="s")) == [("", False)]


HOSTILE = ["</turn>", r"\</turn>", "<turn role=\"user\">\n", "\\", "\\\\<", '">', "<\\turn", "", "é\n</turn>\n", r"a\tb <b>"]


def test_escape():
    for text in [*HOSTILE, "".join(HOSTILE)]:
        assert unescape(escape(text)) == text
        assert "</turn" not in escape(text) and "<turn" not in escape(text) and '">' not in escape(text)


def test_chats(spark):
    rows = [(1, i, ["user", "assistant", "system", None][i % 4], text) for i, text in enumerate(HOSTILE)]
    rows += [(2, None, "assistant", None), (2, 1, 'x">\n', "b"), (2, 1, 'x">\n', "b"), (None, 1, "user", "z")]
    turns = spark.createDataFrame([(*row, 0) for row in rows], "conv_id long, turn long, role string, text string, loss int")
    pieces = format_conversations(turns, piece_chars=20)
    assert pieces.groupBy("conv_id").count().where("conv_id = 1").first()[1] > 1
    by_id = {}
    for conv_id, turn, role, text in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], -1 if r[1] is None else r[1])):
        by_id.setdefault(conv_id, []).append((role or "", text or ""))
    for digests in (conversation_digests(pieces, in_order=True), conversation_digests(pieces)):
        got = {row.conv_id: row for row in digests.collect()}
        assert got.keys() == by_id.keys()
        for conv_id, said in by_id.items():
            row = got[conv_id]
            loss = "".join(text for role, text in said if role == "assistant")
            assert row.n_turns == len(said)
            assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
            assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert format_conversations(turns.limit(0)).count() == 0
