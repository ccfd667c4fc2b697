"""Templates, reading back, and the main text of pages."""

from __future__ import annotations

import hashlib
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallgrove.llm import chat_format, html_extract
from tallgrove.llm.chat_format import TEMPLATE, TURN, TemplateError, compile_template, fold_block, guard, parse, unguard
from tallgrove.llm.html_extract import Page


def rendered(template: str, **names) -> str:
    return "".join(text for text, _, _ in compile_template(template)(names))


def test_templates():
    assert rendered("a{{ 'x' ~ 1 | upper }}b") == "ax1b"
    assert rendered("{{ ('x' ~ y) | upper }}", y="z") == "XZ"
    assert rendered("{% for m in xs %}{{ loop.index }}{{ m.a }}{% if not loop.last %},{% endif %}{% endfor %}", xs=[{"a": "p"}, {"a": "q"}]) == "1p,2q"
    assert rendered("{% if a == 'x' and not b %}1{% elif b or c != 2 %}2{% else %}3{% endif %}", a="y", b=0, c=2) == "3"
    assert rendered("{{ missing.field }}{{ none }}") == ""
    assert rendered("{% for m in xs %}[{{ m }}{% if loop.last %}.{% endif %}]{% endfor %}", xs=["a", None, "b", None]) == "[a][][b][.]"
    assert rendered("{% for m in xs %}[{{ m }}]{% endfor %}", xs=[None]) == "[]"


def test_folding():
    assert fold_block(parse("a{{ 'b' | upper }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}")) == (chat_format.Text("aBc"),)


@pytest.mark.parametrize(
    "bad", ["{{ x.__class__ }}", "{{ f() }}", "{% import os %}", "{{ x | eval }}", "{% for m in xs %}", "{{ ( }}", "{{ a b }}", "{% endif %}", "{{ 'a }}"]
)
def test_sandbox(bad):
    with pytest.raises(TemplateError):
        compile_template(bad)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b", "\\", ""]), st.text(st.sampled_from("ab\\#<>/:\n "), max_size=30)), max_size=4))
def test_round_trip(turns):
    text = rendered(TEMPLATE, messages=[{"role": r, "text": t} for r, t in turns])
    at, back = 0, []
    while at < len(text):
        found = TURN.match(text, at)
        back.append((unguard(found[1]), unguard(found[2])))
        at = found.end()
    assert back == turns
    assert all(unguard(guard(t)) == t for _, t in turns)


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (None, 0, "assistant", "### x: </turn>\n"), (3, None, "assistant", "n"),
        (3, 2, "assistant", "m"), (3, 2, "assistant", "m"), (3, 2, "assistant", "l"),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, place int").repartition(4)
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(df)).collect()}

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert got[1]["turns_sha256"] == sha("user\na\nassistant\nb\n") and got[1]["loss_sha256"] == sha("b")
    assert (got[2]["n_turns"], got[2]["loss_chars"], got[2]["turns_sha256"]) == (1, 0, sha("\n\n"))
    assert (got[None]["loss_chars"], got[None]["loss_sha256"]) == (15, sha("### x: </turn>\n"))
    assert (got[3]["n_turns"], got[3]["loss_sha256"]) == (4, sha("nlmm"))
    assert chat_format.read_back(chat_format.format_turns(df.limit(0))).collect() == []


def main(page: str) -> str:
    read = Page(page)
    return "\n".join(read.text_at(read.best()))


def test_pages():
    assert main("") == "" and main("plain &amp; text") == "plain & text"
    assert main("<body><nav><a href=x>Home</a></nav><div class='post main'><h1>T</h1><p>one <b>two</b>\n three<p>four</div><div class='side-bar ad'>x</div></body>") == "T\none two three\nfour"
    assert main("<article><p>a<script>if (x < 1) '</p>'</script>b</p><!-- <p>c</p> --><form><p>no</p></form><p>d&lt;e&gt;</article><footer>f</footer>") == "ab\nd<e>"
    assert main("<div id=cookie-notice>we use cookies, very many of them indeed</div><article>short<section class=comments><p>" + "long comment " * 9 + "</p></section></article>") == "short"
    assert main("<article><p>cut off text<p>and mo") == "cut off text\nand mo"
    assert main("<article><p>x</p><p>last</p></art") == "x\nlast"
    assert main("<table><tr><td>" + "cell text " * 9 + "<td><a href=y>link</a></table>").startswith("cell text")
    assert main("<script>unclosed <p>x") == ""


def test_whole_articles():
    """Titles and leads beside the longest container of an article stay; so does an article in a wrapper named like furniture."""
    long = "body of the text " * 40
    whole = f"title\nlead\n{long.strip()}"
    inner = f"<h1>title</h1><p>lead</p><div class=body>{long}</div>"
    for outer in ("article", "main", "div class=post"):
        assert main(f"<body><{outer}>{inner}</{outer.split()[0]}><div class=box>other</div></body>") == whole
    assert main(f"<div class=post><div class=top><h1>title</h1></div><p>lead<div class=body>{long}</div></div>") == whole
    for tag in ("blockquote", "section"):
        assert main(f"<article><h1>title</h1><p>lead</p><{tag}>{long}</{tag}></article>") == whole
    assert main(f"<article><h1>title</h1><p>lead</p><table><tr><td>{long}</table></article>") == whole
    side = "<div class=sidebar><p>side</p></div>"
    for wrapper in ("div class='page has-sidebar'", "section id=menu-page", "div class=header-fixed"):
        for tag in ("article", "main", "div"):
            page = f"<body><{wrapper}><{tag}>{inner}</{tag}>{side}</{wrapper.split()[0]}></body>"
            assert main(page) == whole, page
    assert main(f"<main><h1>top</h1><div class='has-sidebar'><article>{inner}</article>{side}</div></main>") == "top\n" + whole
    talk = "<div id=comments>" + f"<article><p>comment {long}</p></article>" * 3 + "</div>"
    assert main(f"<article>{inner}</article>{talk}") == whole
    assert main(f"<main><article>{inner}</article>{talk}</main>") == whole
    teasers = "<div class=sidebar><article><p>teaser</p></article></div>"
    assert main(f"<body><div class='page has-sidebar'><article>{inner}</article></div>{teasers}</body>").startswith(whole)
    assert main(f"<article><p>some <span class=share>Share</span> words</p>{side}</article>") == "some words"


def test_compound_names_of_running_text():
    names = ("ad-hoc", "search-results", "social-history", "notice-of-claim", "related-work", "widget-theory")
    kept = "".join(f"<p class='{n}'>{n} text</p>" for n in names)
    assert main(f"<article><h2 class=header-2>title</h2>{kept}<p class='wide ad'>buy</p></article>") == "\n".join(["title", *[f"{n} text" for n in names]])


def test_hosts_keep_whole_articles(spark):
    """Votes of a host's pages do not cut its pages to a part of the article."""
    page = "<body><div class='page has-sidebar'><article><h1>title</h1><p>lead</p><div class=body>" + "long text " * 60 + "</div></article></div></body>"
    df = spark.createDataFrame([(i, f"http://w.example/{i}", page) for i in range(3)], "page_id long, url string, html string")
    assert {r["text"] for r in html_extract.extract(df).collect()} == {"title\nlead\n" + ("long text " * 60).strip()}


def test_hosts_agree(spark):
    """A page whose longest container is not the host's: the host's path wins."""
    good = "<body><div class='content-{0}'><p>" + "text of the page " * 6 + "</p></div><div class='box'><p>box</p></div></body>"
    odd = "<body><div class='content-9'><p>tiny</p></div><div class='box'><p>" + "other words here " * 20 + "</p></div></body>"
    rows = [(i, f"http://h.example/{i}", good.format(i)) for i in range(5)]
    rows += [(10, "https://u@H.example?q", odd), (11, "http://alone.example/", odd), (12, None, odd), (13, "http://h.example/", None), (14, "no url", "x"), (14, "no url", "x")]
    df = spark.createDataFrame([(*r, "old", 0) for r in rows], "page_id long, url string, html string, text string, extra int")
    got = html_extract.extract(df).collect()
    by = {r["page_id"]: r for r in got}
    assert by[10]["text"] == "tiny" and by[11]["text"].startswith("other words") and by[12]["text"] == by[11]["text"]
    assert by[13]["text"] == "" and by[13]["n_chars"] == 0 and by[14]["text"] == "x" and len(got) == len(rows)
    assert html_extract.extract(df.limit(0)).collect() == []


def test_long_broken_pages_take_time_by_length():
    pages = {
        "<div>t " * 50_000: 50_000,
        "<a b='" * 40_000: 1,
        "<a b='>" * 40_001: 0,
        "<b>" * 30_000 + "<p>x" * 30_000: 30_000,
        "<b>" * 30_000 + "</i>x" * 30_000: 1,
        "<ul><li>a" * 30_000: 30_000,
        "< " * 100_000: 1,
    }
    started = time.perf_counter()
    for source, blocks in pages.items():
        page = Page(source)
        assert len(page.text_at(page.best())) == blocks, source[:20]
    assert time.perf_counter() - started < 20


def test_names_of_containers_around_titles():
    page = Page("<body><div class='post'><div class='entry-header'><h1>Title</h1></div><div><p>long text</p></div></div></body>")
    assert page.text_at("") == ["Title", "long text"]
    assert Page("<div class='header'><h1>Site</h1></div><div><p>long text</p></div>").text_at("") == ["long text"]


def test_tags_that_do_not_end():
    assert Page("a <b title='x>y'>c</b> <i d=\"e> f</i> < 3 <u").text_at("") == ["a c f < 3"]
    assert Page("one <!-- two > three --> four <!-- five").text_at("") == ["one four"]
    assert Page("<p>x<script>if (a < b) '</p>'</script>y<style>z").text_at("") == ["xy"]
