"""HTML extraction and chat formatting on awkward input."""

import hashlib
import random
import time
import tracemalloc

import pytest

from evenfield.llm import chat_format, html_extract

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href="/">Home</a><li><a href="/x">More</a></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>hidden</p> -->
<div class="layout7"><article class="post-12"><h1>Title &amp; more</h1><p>First <b>bold</b>
   text&nbsp;here.<br>Next line<p>Second &lt;p&gt; with a < b and &#233;&#x41;<div class="ad">Buy now</div><ul><li>One<li>Two</ul>
<form><label>Name</label><input name=x><button>Go</button></form><table><tr><td>cell one<td>cell two</table></article>
<aside>Related things</aside><section id="comments"><p>A reader said something long that is not the article at all.</p></section></div><footer>&copy; 2020</footer></body></html>"""
TEXT = "Title & more\nFirst bold text here. Next line\nSecond <p> with a < b and éA\nOne\nTwo\ncell one\ncell two"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)


def test_article_without_what_surrounds_it(spark):
    rows = [(k, f"http://www.a.example/{k}", PAGE.replace("post-12", f"post-{k}")) for k in range(5)]
    found = {r["page_id"]: r for r in html_extract.extract(pages(spark, rows)).collect()}
    assert len(found) == 5 and all(r["text"] == TEXT and r["n_chars"] == len(TEXT) for r in found.values())


def test_hosts_agree_where_a_page_alone_would_err(spark):
    long = "<p>" + "long article text " * 40 + "</p>"
    short = "<html><body><div class=text><p>Short one.</p></div><div class=box><p>" + "something else of this page " * 8 + "</p></div></body></html>"
    rows = [(k, "http://a.example/", f"<html><body><div class=text>{long}</div><div class=box><p>small</p></div></body></html>") for k in range(6)] + [(9, "https://m.a.example/y", short)]
    found = {r["page_id"]: r["text"] for r in html_extract.extract(pages(spark, rows)).collect()}
    assert found[9] == "Short one."


@pytest.mark.parametrize("most", [0, 100])
def test_null_empty_cut_and_repeated_pages(spark, most):
    rows = [(1, None, None), (2, "not a url", ""), (3, "http://b.example", "<html><body><article><p>cut off <b>he"), (3, "http://b.example", "<html><body><article><p>cut off <b>he"), (4, "http://b.example", "just text &am"), (None, "http://b.example", "<p>x</artic"), (5, "u", "<" * 50), (6, "u", "<div " + "a" * 20000)]
    found = html_extract.extract(pages(spark, rows), html_extract.HtmlParams(broadcast_hosts=most)).collect()
    assert len(found) == len(rows)
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts[1] == texts[2] == texts[6] == "" and texts[3] == "cut off he" and texts[None] == "x"
    assert html_extract.extract(pages(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("name", ["ad", "ad-slot", "ad-x71", "post-comments", "cookie-notice", "newsletter-signup", "comment-body", "sponsored-post"])
def test_names_of_boilerplate(name):
    assert html_extract.is_boilerplate(name)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article><div title="the hidden life"><p>Kept.</p></div><p>More.</p></article>', "Kept.\nMore."),
        ("<article><div hidden><p>No.</p></div><div data-x='a' HIDDEN=1><p>No.</p></div><p>More.</p></article>", "More."),
        ("<body><form action=/x><article><h1>Title</h1><p>" + "Long text of it. " * 9 + "</p><button>Go</button></article></form></body>", "Title\n" + ("Long text of it. " * 9).strip()),
        ("<article><p>" + "Long text of it. " * 9 + "</p><form><p>Your name</p><label>Name</label><input></form></article>", ("Long text of it. " * 9).strip()),
        ("<article><p>One.</p><noscript><p>Two.</p><p>Three.</p></article>", "One.\nTwo.\nThree."),
        ("<article><p>One.</p><noscript><p>Two.</p></noscript><svg><text>x</text></svg><p>Three.</p></article>", "One.\nThree."),
        ("<article><p>One.</p><object><p>Two.<video><p>Three.</article>", "One.\nTwo.\nThree."),
        ('<article><h2 class="social">On society</h2><p class="notice">A notice.</p><div class="related"><p>A related thought of the author.</p></div></article>', "On society\nA notice.\nA related thought of the author."),
        ('<article><p>Body of the text.</p><div class="related"><ul><li><a href=1>One more</a><li><a href=2>Another</a></ul></div></article>', "Body of the text."),
        ("<article><p>By <math><mi>x</mi><mo>=</mo><mn>2</mn></math> so.</p><menu><li>An item</menu><p><label>Lab</label></p></article>", "By x=2 so.\nAn item\nLab"),
        ('<article><p>Text.</p><div class="comments"><p>First!</p></div></article>', "Text."),
        ('<article><p>Text.</p><div class="banner-image"><p>A caption.</p></div></article>', "Text.\nA caption."),
        ('<article><p>Text.</p><section id="comment-on-the-law"><p>A thought.</p></section></article>', "Text.\nA thought."),
        ('<article><p>Text.</p><section class="ads-analysis"><p>On adverts.</p></section></article>', "Text.\nOn adverts."),
        ('<article><p>Text.</p><table class="menu"><tr><td>Soup<td>4</table></article>', "Text.\nSoup\n4"),
        ('<div class="menu"><p>Soup</p></div><article><p>Text.</p><table class="menu"><tr><td><a>One</a><td><a>Two</a></table></article>', "Text."),
        ('<div class="header"><p>Site</p></div><article><div class="header"><h1>Head</h1></div><p>Text.</p></article>', "Head\nText."),
        ("<article><p>Press <button>OK</button> now.</p><p>&nbsp;<button>Send</button></p><button>Go</button></article>", "Press OK now."),
        ('<article><p>Text.</p><div class="share">See <a href=1>the long report of the year</a>.</div></article>', "Text.\nSee the long report of the year."),
        ('<article><p>Text.</p><div class="share"><a href=1>Send this to a friend</a></div></article>', "Text."),
    ],
)
def test_what_stays_in_an_article_and_what_goes(page, text):
    assert html_extract.main_text(page, None) == text


def test_made_pages_against_their_parts(spark):
    """Pages put together from parts of which it is known whether they belong to the article."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["ti", "on", "er", "és", "an"]) for _ in range(rng.randint(1, 4)))
    line = lambda n: " ".join(word() for _ in range(n))
    rows, expected = [], {}
    for k in range(60):
        inside, told = [], []
        for _ in range(rng.randint(3, 9)):
            t = line(rng.randint(4, 40))
            kind = rng.choice(["p", "h2", "li", "pre", "bold", "entity", "comment", "ad", "script", "form", "share"])
            if kind in ("comment", "ad", "script", "form", "share"):
                inside.append({"comment": f"<!-- <p>{t}</p> -->", "ad": f'<div class="ad-box"><p>{t}</p></div>', "script": f"<script>'<p>{t}</p>'</script>", "form": "<form><p>Sign up</p><input><button>Go</button></form>", "share": '<div class="share"><a href=1>mail</a> <a href=2>post</a></div>'}[kind])
                continue
            inside.append({"p": f"<p>{t}", "h2": f"<h2 class=related>{t}</h2>", "li": f"<ul><li>{t}</ul>", "pre": f"<pre>{t}\n  x</pre>", "bold": f"<p><b>{t}</b>&nbsp;&amp; x</p>", "entity": f"<p>&lt;{t}&#62;</p>"}[kind])
            told.append({"pre": f"{t} x", "bold": f"{t} & x", "entity": f"<{t}>"}.get(kind, t))
        core = line(60)
        page = f"<html><head><title>{line(3)}</title></head><body><nav><a href=/>Home</a></nav><header><p>{line(30)}</p></header><div id=c{k}><article><p>{core}</p>{''.join(inside)}</article></div><aside><p>{line(50)}</p></aside><footer>{line(9)}</footer></body></html>"
        rows.append((k, f"http://h{k % 3}.example/{k}", page))
        expected[k] = "\n".join([core, *told])
    found = html_extract.extract(pages(spark, rows)).collect()
    assert {r["page_id"]: r["text"] for r in found} == expected


def test_blocks_that_a_host_repeats(spark):
    """Pages of several hosts against a count of their parts by hand: what repeats goes, articles under several urls stay."""
    rng = random.Random(4)
    line = lambda n: " ".join("".join(rng.choice(["ti", "on", "er", "an"]) for _ in range(rng.randint(1, 5))) for _ in range(n))
    notice = {h: line(12) for h in range(4)}
    rows, parts = [], []
    for k in range(120):
        host = k % 4
        own = [("own", line(40)), ("own", line(9))]
        if host == 3:  # four different pages only, in many copies
            own = [("own", f"{'page ' * 40}{(k // 4) % 4}"), ("own", "the same nine words on all of these pages")]
        if rng.random() < (0.8, 0.3, 0.6, 0.8)[host]:
            own.append(("note", notice[host]))
        own += [("own", "Of."), ("doubt", "Read more"), ("doubt", line(3))][: rng.randint(1, 3)]
        page = "".join({"own": f"<p>{t}</p>", "note": f"<p>{t}</p>", "doubt": f"<div class=related><p>{t}</p></div>"}[kind] for kind, t in own)
        rows.append((k, f"http://h{host}.example/{k}", f"<body><article>{page}</article></body>"))
        parts.append((host, own))
    longest = [max((t for _, t in own), key=lambda t: (len(t), t)) for _, own in parts]
    different = {h: {c for c, (g, _) in zip(longest, parts) if g == h} for h in range(4)}

    def stays(host, kind, text):
        on = len({c for c, (g, own) in zip(longest, parts) if g == host and any(t == text for _, t in own)})
        return not ((kind == "doubt" or len(text.split()) >= 8) and on >= 5 and 2 * on >= len(different[host]))

    expected = {k: "\n".join(t for kind, t in own if stays(host, kind, t)) for k, (host, own) in enumerate(parts)}
    for params in (html_extract.HtmlParams(), html_extract.HtmlParams(broadcast_hosts=0)):
        assert {r["page_id"]: r["text"] for r in html_extract.extract(pages(spark, rows), params).collect()} == expected
    gone = [t for h, own in parts for kind, t in own if not stays(h, kind, t)]
    assert set(gone) >= {notice[0], notice[2], "Read more"} and notice[1] not in gone and notice[3] not in gone


def test_long_pages_take_time_in_proportion():
    began = time.time()
    for page in ("<p>" + "word " * 1_000_000, "<noscript>" * 100_000, "<div hidden x='" * 50_000, "<article>" + "<p>a<svg>" * 100_000):
        html_extract.main_text(page, None)
    assert time.time() - began < 60


@pytest.mark.parametrize("name", ["post", "has-sidebar", "no-comments", "entry-header", "advice", "commentary", "content-ad", "banner-image", "comment-on-the-law", "ads-analysis"])
def test_names_of_content(name):
    assert not html_extract.is_boilerplate(name)


def test_deep_markup_ends(spark):
    deep = "<html><body><article>" + "<div><p><span>" * 400 + "core" + "</span></p></div>" * 400 + "</article></body></html>"
    assert html_extract.main_text(deep, None) == "core"


@pytest.mark.parametrize("page", ["<div class=abcdefgh>" * 100_000, "<span>" * 100_000 + "</b>" * 100_000, "<span>" * 50_000 + "<p>x" * 50_000, "<form>a" * 50_000 + "<header>" * 50_000, "<div class=share>a <a>b</a>" * 50_000])
def test_time_and_memory_go_with_the_length_of_a_page(page):
    tracemalloc.start()
    began = time.process_time()
    html_extract.main_text(page + "core", None)
    taken, (_, peak) = time.process_time() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 200e6 and taken < 40  # tracing costs several times the work itself


def test_elements_within_doubted_ones_count_for_them():
    links = "<a>" + "link " * 20 + "</a>"
    page = f"<article><p>{'text ' * 50}</p><div class=share>in <div class=related>{links}</div></div><div class=share>{'words ' * 40}<div class=related>{links}</div></div></article>"
    assert html_extract.main_text(page, None) == "\n".join([("text " * 50).strip(), ("words " * 40).strip()])


BITS = ["</s>", "[INST] ", " [/INST]", "<s>", "\\", "[", "<", " ", "a", "\n", "/", "INST", "[INST", "/INST]", "é", "\\\\", "user", "s>", ""]


def test_any_turns_read_back():
    rng = random.Random(3)
    template = chat_format.Template()
    for _ in range(4000):
        turns = [(rng.choice(["user", "assistant", "system", "", "we[INST] ird"]), "".join(rng.choice(BITS) for _ in range(rng.randint(0, 7)))) for _ in range(rng.randint(0, 4))]
        made = chat_format.format_turns(turns, template)
        assert [(r, t) for r, t, _, _ in chat_format.parse(made.text, template)] == turns
        assert "".join(template.unmask(made.text[a:b]) for a, b in made.spans) == "".join(t for r, t in turns if r == "assistant")


def test_plain_turns_stay_as_they_are():
    made = chat_format.format_turns([("user", "hi [there]"), ("assistant", "a < b")])
    assert made.text == "<s>[INST] user [/INST]hi [there]</s>[INST] assistant [/INST]a < b</s>"


@pytest.mark.parametrize("text", ["", "<s>[INST] user [/INST]open", "<s>stray", "<s>[INST] user [/INST]a[INST] b</s>"])
def test_what_is_no_conversation_is_refused(text):
    with pytest.raises(chat_format.GrammarError):
        chat_format.parse(text, chat_format.Template())


def test_conversations_of_all_kinds(spark):
    rows = [(1, 1, "assistant", "second"), (1, 0, "user", "first"), (2, 0, "user", None), (2, 1, None, "x"), (3, 0, "assistant", "y" * 50_000), (4, 0, "user", "same"), (4, 0, "user", "same"), (None, 0, "user", "who"), (5, None, "assistant", "late"), *chat_format.HOSTILE]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    found = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_conversations(frame)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert found[1]["turns_sha256"] == sha("user\nfirst\nassistant\nsecond\n") and found[1]["loss_sha256"] == sha("second")
    assert found[2]["turns_sha256"] == sha("user\n\n\nx\n") and found[2]["loss_chars"] == 0
    assert found[3]["loss_chars"] == 50_000 and found[4]["n_turns"] == 2 and len(found) == 7
    assert found[-7]["loss_sha256"] == sha("</s>[INST] ok [/INST]") and found[-7]["n_turns"] == 2
    assert chat_format.digests(chat_format.format_conversations(frame.limit(0))).count() == 0
