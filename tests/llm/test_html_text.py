import html
import re

import pytest

from tidemark.llm import html_text as H

PAGE = """<html><head><title>t</title></head><body><header class="site"><h1>Site</h1><p>slogan, here.</p></header><nav><a href=x>Home</a></nav>
<div class="wrap has-sidebar"><div id="sidebar"><h3>Links</h3><ul><li><a>one</a></li></ul><p>Side text, with marks, and more words.</p></div>
<div class="cookie-notice"><p>We use cookies, please accept them.</p></div>
<div class="post"><h2>Title of it</h2><p>First paragraph, of the article &amp; more&nbsp;words; a < b holds. It goes on, and on, and on.</p><ul><li>item one<li>item two</ul>
<div class="ad">Buy, now!</div><blockquote>Quoted text, short.</blockquote><p>Second paragraph is here, with a <a href=z>link</a> inside. And so on.</p>
<form><label>Mail</label><input><button>Go</button></form></div>
<section id="comments"><h3>2 Comments</h3><article class="comment"><p>I like this article, it is good, and long.</p></article></section>
</div><footer><p>(c) 2020, Site. All rights.</p></footer></body></html>"""


def test_boilerplate_of_all_kinds_goes_and_the_article_stays():
    assert H.main_text(PAGE) == ("Title of it\nFirst paragraph, of the article & more words; a < b holds. It goes on, and on, and on.\n"
                                 "item one\nitem two\nQuoted text, short.\nSecond paragraph is here, with a link inside. And so on.")


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text\n", "plain text"), ("<div><!-- open", ""), ("<p>a<script>x<p>b", "a"), ("x<!-- a <b> c", "x"), ("<p>x</p><style>p{}</style>y", "x\ny"), ("<p>x<!-- y -->z", "xz"),
    ("a <b>b</b> c<br>d", "a b c d"), ("<p>x &lt;b&gt; &eacute;&#233;", "x <b> éé"), ("1 < 2 and <3", "1 < 2 and <3"),
    ("<article><header><h1>T</h1><p>by me</p></header><p>x</p>", "T\nx"), ("<p title='>'>q</p>", "q"), ("<p title=it's>q</p>", "q"),
    ("<nav>menu</nav>", ""), ("<article><p>" + "word " * 30000, ("word " * 30000).strip())])
def test_small_pages(page, text):
    assert H.main_text(page) == text


@pytest.mark.parametrize("page", ["<div>x" * 40000, "<b>" * 60000 + "x", "<p>x" * 50000, "<li>" * 50000, "<" * 200000, "<a href='" * 20000,
                                  "<!--" * 50000, "</div>" * 50000, "<table><tr><td>x" * 20000, "<p title='x>" * 30000])
def test_strange_pages_take_time_in_proportion(page):
    import time

    start = time.process_time()
    H.main_text(page)
    assert time.process_time() - start < 8


def test_text_outside_known_tags_is_found_by_its_path():
    body = "".join(f"<div class=c{i}><span>Sentence {i}, which says something, in so many words.</span></div>" for i in range(5))
    page = f"<body><div class=x><div>{body}</div></div><div class=y><ul>" + "<li><a href=q>go</a></li>" * 9 + "</ul></div></body>"
    assert H.main_text(page).split("\n") == [f"Sentence {i}, which says something, in so many words." for i in range(5)]


def test_path_scores_select_inside_an_article():
    text = "A paragraph of the article, which says a lot, and goes on, and on, for many words. " * 4
    short = "".join(f"<div class=q{i}>{w}</div>" for i, w in enumerate(("5 min", "Tap here", "Print", "A A A", "Top")))
    page = f"<article><h1>T</h1>{short}<p>{text}</p><ul><li>item</ul><p>{text}</p>{short}</article>"
    assert H.main_text(page).split("\n") == ["T", text.strip(), "item", text.strip()]


def test_parts_outside_the_largest_element_and_named_parts_stay():
    text = "One sentence of it, with marks, and more words."
    page = f"<body><div class=lead><p>{text}</p></div><div class=body>{f'<p>{text} {text}</p>' * 3}</div></body>"
    assert H.main_text(page).split("\n") == [text] + [f"{text} {text}"] * 3
    page = (f"<article><h2 id='related-work'>Related work</h2><p>{text}</p><section id='discussion'><h3>D</h3><p>{text} {text}</p></section>"
            f"<pre id=form-validation>x = 1</pre><p>{text} <span class=share>ok</span></p><p><a href=a>{text}</a></p></article>")
    assert H.main_text(page).split("\n") == ["Related work", text, "D", f"{text} {text}", "x = 1", f"{text} ok", text]
    text = " ".join([text] * 9)
    page = f"<article><p>{text}</p><section id='related'><div>{'<div>Go on</div>' * 9}</div></section></article>"
    assert H.main_text(page) == text


TEXT = "One sentence of it, with marks, and more words that go on. And a second one, which is as long."


def test_articles_inside_forms_and_named_wrappers_stay():
    body = f"<p>{TEXT}</p>" * 3
    want = "\n".join([TEXT] * 3)
    controls = "<select><option>One, two.<option>Three</select><label>Mail</label><input type=text><button>Send it, now</button>"
    assert H.main_text(f"<body><form action=x><div>{body}</div>{controls}</form></body>") == want
    assert H.main_text(f"<body><div>{body}</div><form>Write to us, please, and soon.{controls}</form></body>") == want
    assert H.main_text(f'<body><div id=page class="has-sidebar">{body}</div></body>') == want
    assert H.main_text(f'<body><div id=page class="has-sidebar">{body}<div class=sidebar><p>Side text, with marks.</p></div></div></body>') == want


def test_names_inside_an_article_are_no_veto():
    page = (f"<article><header><h1>T</h1><p>{TEXT}</p></header><p>{TEXT}</p><p class='related'>{TEXT}</p><div class=reply>{TEXT} {TEXT}</div>"
            f"<p role=status>{TEXT}</p><div class=ad>Buy</div><h2>References</h2><ul><li><a href=a>Smith, J., A title of some length, 2010.</a>"
            f"<li><a href=b>Home</a></ul></article>")
    assert H.main_text(page).split("\n") == ["T", TEXT, TEXT, TEXT, f"{TEXT} {TEXT}", TEXT, "References", "Smith, J., A title of some length, 2010."]


def test_parts_of_a_sentence_do_not_split_it():
    page = (f"<article><p>Press <button>Save</button> and then, as x<math><mi>y</mi><mo>=</mo><mn>2</mn></math> holds, "
            f"<select><option>a<option>b</select>go <svg><text>icon</text></svg>on.</p><p>{TEXT}</p></article>")
    assert H.main_text(page) == f"Press Save and then, as xy=2 holds, go on.\n{TEXT}"


def test_articles_compete_by_score():
    main = f"<article><h1>T</h1>{f'<p>{TEXT}</p>' * 4}</article>"
    teaser = "<article class=teaser><h3>Next</h3><p>A short one, to click.</p></article>"
    assert H.main_text(f"<body>{main}{teaser}</body>").split("\n") == ["T", *[TEXT] * 4]
    plain = f"<div><h1>T</h1>{f'<p>{TEXT}</p>' * 4}</div>"
    assert H.main_text(f"<body>{plain}{teaser}{teaser}</body>").split("\n")[:5] == ["T", *[TEXT] * 4]  # prose outside wins the scope
    thread = f"<section id=comments>{'<article class=comment><p>I like it, a lot, and more.</p></article>' * 9}</section>"
    assert H.main_text(f"<body>{main}{thread}</body>").split("\n") == ["T", *[TEXT] * 4]
    assert H.main_text(f"<body>{plain}{thread}</body>").split("\n") == ["T", *[TEXT] * 4]


def plain_scores(blocks, path):
    """The path ratios by their definition, path by path, with plain lists."""
    def mean(p, value):
        own = [value(b) for b, q in zip(blocks, path) if q == p]
        return sum(own) / len(own)

    out = {}
    for p in set(path):
        fused = []
        for value in (lambda b: max(0, len(b.text) - b.links), lambda b: sum(c in ".,;:!?…。、，！？；：¿¡" for c in b.text)):
            at = [mean(q, value) for q in path]
            smooth = [0.25 * at[max(i - 1, 0)] + 0.5 * at[i] + 0.25 * at[min(i + 1, len(at) - 1)] for i in range(len(at))]
            own = [s for s, q in zip(smooth, path) if q == p]
            fused.append(sum(own) / len(own))
        has_text = any(len(b.text) > b.links for b, q in zip(blocks, path) if q == p)
        out[p] = (fused[0] * (fused[1] + 1)) ** 0.5 if has_text else 0.0
    return out


def test_path_scores_match_their_definition():
    import random

    rng = random.Random(3)
    for n in (1, 2, 9, 40):
        blocks = [H.Block("".join(rng.choice("ab ,.;?") for _ in range(rng.randint(1, 60))), rng.choice([0, 0, 5, 60]), 0) for _ in range(n)]
        path = [rng.randint(0, 6) for _ in range(n)]
        got, want = H.path_scores(blocks, path), plain_scores(blocks, path)
        assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in want)


def test_disabling_the_scores_changes_the_result(monkeypatch):
    """On pages without names or semantic tags only the path ratios tell text from the rest."""
    page = (f"<body><div><div>{'<div>Go on</div>' * 6}</div></div><div><div><h1>T</h1>{f'<p>{TEXT}</p>' * 4}</div></div>"
            f"<div><table><tr>{'<td>12 px</td>' * 8}</tr></table></div></body>")
    want = "\n".join(["T", *[TEXT] * 4])
    assert H.main_text(page) == want
    monkeypatch.setattr(H, "path_scores", lambda blocks, path: {p: 1.0 for p in path})
    assert H.main_text(page) != want


def test_whole_table_gives_the_article(spark):
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    from tidemark.llm.queries import op6_html_text

    got = {r.page_id: r for r in op6_html_text(spark, sf).collect()}
    want = pages.collect()
    assert len(got) == len(want)
    for p in want:
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", p.html, re.S)[1]
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>|<br>", article)]
        r = got[p.page_id]
        assert r.text == "\n".join(x for x in lines if x) and r.n_chars == len(r.text) and r.url == p.url


def test_edge_cases(spark):
    pages = spark.createDataFrame([(None, None, None), (1, "u", "<p>x"), (1, "u", "<p>x")], "page_id long, url string, html string")
    out = H.extract(pages.selectExpr("*", "1 as text", "2 as n_chars")).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in out) == [(0, "", 0), (1, "x", 1), (1, "x", 1)]
    assert H.extract(pages.limit(0)).count() == 0
