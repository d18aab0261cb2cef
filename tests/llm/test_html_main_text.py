import random
from itertools import product

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import html_main_text as hm


def page(rng, n, marked=True):
    words = [f"word{i}" for i in range(200)]

    def text(k):
        return " ".join(rng.choice(words) for _ in range(k)).capitalize() + "."

    body = [f"<h1>{text(6)}</h1>"] + [f"<p>{text(rng.randrange(8, 60))}" + ("</p>" if rng.random() < .7 else "") for _ in range(n)]
    tag = "article" if marked else "div"
    truth = hm.leaf_blocks("".join(body))
    html = (f"<!DOCTYPE html><html><head><title>{text(3)}</title><style>p{{}}</style></head><body><nav><ul>"
            + "".join(f"<li><a href='/{i}'>{rng.choice(words)}</a></li>" for i in range(rng.randrange(3, 8)))
            + f"</ul></nav><!-- x --><div class=\"ad\">{text(7)}</div><{tag}>{''.join(body)}</{tag}>"
            + f"<footer>&copy; site.example &middot; {text(5)}</footer><script>var a = '</p>';</script></body></html>")
    return html, "\n".join(b.text for b in truth)


def test_blocks():
    html = """<p>a &amp; b<b>old</b> <i>x</i>&nbsp;y<p>two<br>three<script>no("</p>")</script><!-- no <p>z --> four
    <ul><li>one<li>two</ul><a title="a > b" href=x>link</a><textarea>no</textarea><svg><text>no</text></svg>
    <table><tr><td>c1<td>c2<tr><td>c3</table></nosuch><p class='ad big'>last < 5 &lt; 6"""
    assert [b.text for b in hm.leaf_blocks(html)] == [
        "a & bold x y", "two", "three four", "one", "two", "link", "c1", "c2", "c3", "last < 5 < 6"]
    assert hm.leaf_blocks(html)[-1].path[-1] == ("p", frozenset({"ad", "big"}))
    assert hm.leaf_blocks("") == [] and hm.leaf_blocks("<p></p>  ") == []
    assert hm.leaf_blocks("<script>never closed <p>x") == [] and hm.leaf_blocks("<p a=\"open") == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/ab=\"'! -pdiv&;\n", max_size=120))
def test_any_text_is_read(text):
    for b in hm.leaf_blocks(text):
        assert b.text == " ".join(b.text.split()) and b.text


def test_viterbi_is_the_best_labelling():
    rng = random.Random(4)
    for _ in range(60):
        crf = hm.Crf({f"f{i}": rng.uniform(-2, 2) for i in range(5)},
                     [[rng.uniform(-1, 1) for _ in range(2)] for _ in range(2)], [rng.uniform(-1, 1) for _ in range(2)])
        seq = [[f"f{rng.randrange(5)}" for _ in range(rng.randrange(1, 4))] for _ in range(rng.randrange(1, 8))]

        def score(y):
            s = crf.start[y[0]] + sum(sum(crf.weights[f] for f in fs) for fs, l in zip(seq, y) if l)
            return s + sum(crf.step[a][b] for a, b in zip(y, y[1:]))

        assert abs(score(crf.decode(seq)) - max(score(y) for y in product((0, 1), repeat=len(seq)))) < 1e-9
    assert crf.decode([]) == []


def test_training_follows_the_likelihood():
    """Without features the model's pair shares are those of the data."""
    rng = np.random.default_rng(1)
    labels = [(rng.random(12) < 0.3).astype(int).tolist() for _ in range(200)]
    crf = hm.train([[["bias"]] * 12 for _ in labels], labels, steps=400, penalty=0)
    z = np.array([[np.exp(crf.step[a][b] + b * crf.weights["bias"]) for b in (0, 1)] for a in (0, 1)])
    assert 0.2 < z[0, 1] / (z[0, 0] + z[0, 1]) < 0.4


def test_held_out_pages_with_and_without_markup(spark):
    rng = random.Random(7)
    train = [(i, f"u{i}", page(rng, rng.randrange(1, 9))[0], "x") for i in range(120)]
    held = [(1000 + i, None, *page(rng, rng.randrange(3, 9), marked=i % 2 == 0)) for i in range(60)]
    schema = "page_id long, url string, html string, text string"
    model = hm.fit(spark.createDataFrame(train, schema))
    got = {r["id"]: r for r in hm.extract(spark.createDataFrame(held, schema), model).collect()}
    right = [got[i]["text"] == t for i, _, _, t in held]
    assert all(r for k, r in enumerate(right) if k % 2 == 0) and sum(right) >= 55
    assert all(r["n_chars"] == len(r["text"]) and r["url"] is None for r in got.values())


def test_parts_inside_the_article_go():
    rng = random.Random(8)
    pages = [page(rng, 5)[0] for _ in range(60)]
    seen = [e for p in pages for e in hm.examples(hm.leaf_blocks(p))]
    crf = hm.train([s for s, _ in seen], [y for _, y in seen])
    html = """<body><header>Site name</header><main><article><h1>Title of it.</h1><p>Some text of the article, long enough.</p>
    <aside>Related things.</aside><form>Your name <input></form><p>More text of the article, also long.</p>
    <section class="comments"><p>First! A reader says something here.</p></section></article></main>
    <div class="cookie-notice">We use cookies.</div><footer>End.</footer></body>"""
    found = hm.leaf_blocks(html)
    assert [b.text for b, y in zip(found, crf.decode(hm.page_features(found))) if y] == [
        "Title of it.", "Some text of the article, long enough.", "More text of the article, also long."]


def test_edges(spark):
    df = spark.createDataFrame([(1, "u", None), (None, None, ""), (1, "u", None), (2, "u", "<p>x" * 20_000)],
                               "page_id long, url string, html string")
    assert hm.fit(df) is None and hm.fit(df.limit(0)) is None
    assert hm.extract(df, None).count() == 4 and hm.extract(df.limit(0), None).count() == 0


def test_a_head_without_end_ends_where_the_body_starts():
    for start in ("<body><p>", "<p>", "<article>", "<a href=x>", "<img src=x>", "", "<header>", "<body class=x>"):
        blocks = hm.leaf_blocks(f"<!DOCTYPE html><html><head><meta charset=utf-8><title>t</title> <script>s</script>\n{start}text</html>")
        assert [b.text for b in blocks] == ["text"], start
    assert [b.text for b in hm.leaf_blocks("<head><template><p>no</p></template><style>a</style></head><body>text")] == ["text"]


def test_names_of_what_holds_the_article_mark_no_part():
    def zones(html):
        return {b.text: hm.zone(b) for b in hm.leaf_blocks(html)}

    body = "<article><p>a</p><div class=share>s</div></article>"
    for outside in ('<html class="cookies"><body class="no-sidebar">%s', '<body><div class="has-nav">%s</div>',
                    '<body><div id="nav-left"><section class="with-menu">%s</section></div>',
                    '<body><div class="has-nav">%s</div><div class="x"></div>'):
        assert zones(outside % body) == {"a": "main", "s": "other"}, outside
    # parts with articles of their own stay parts
    page = f'<div class="has-nav">{body}<div class="related"><article>r</article></div><div class=menu>m</div></div>'
    assert zones(page) == {"a": "main", "s": "other", "r": "other", "m": "other"}
    assert zones(f'<div class="has-nav"><main>{body}</main></div><div class="related"><article>r</article></div>') == {
        "a": "main", "s": "other", "r": "other"}
    assert zones('<div class="has-nav"><div role="main">a</div></div>') == {"a": "main"}
