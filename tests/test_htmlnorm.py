"""normalize(): broken HTML becomes well-formed XML with a sensible tree."""

import xml.dom.minidom

from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.functions.htmlnorm import normalize


def _xml(html):
    x, h, starts, lens = normalize(html)
    xml.dom.minidom.parseString(x.encode("utf-8"))
    return x, h, starts, lens


def _outer(html, nid):
    _, h, starts, lens = normalize(html)
    return h[starts[nid] - 1: starts[nid] - 1 + lens[nid]]


def test_unclosed_p_li_b_and_void_tags():
    x, h, _, _ = _xml("<p>a<b>bold<p>c<ul><li>x<li>y</ul><br><img src=i.png>")
    assert "<p _nid=\"2\">a<b _nid=\"3\">bold</b></p>" in x
    assert h.count("<li>") == 2 and "<br>" in h and "</br>" not in h


def test_script_text_is_not_markup():
    x, h, _, _ = _xml('<html><head><script>var t="</p>"; if (a<b) {}</script></head><body><p>x</p></body></html>')
    assert 'var t="</p>"' in h
    assert "&lt;/p&gt;" in x


def test_entities_control_chars_duplicate_attributes():
    x, h, _, _ = _xml('<div id="a" id="b" class="c">&nbsp;x\x01y &amp; &lt;z&gt;</div>')
    assert 'id="a"' in x and 'id="b"' not in x
    assert "\x01" not in x and "\xa0xy &amp; &lt;z&gt;" in x


def test_missing_wrappers_and_stray_end_tags():
    x, _, _, _ = _xml("hello</span></div>")
    assert x.startswith('<html _nid="0"><body _nid="1"><p _nid="2">hello</p>')


def test_end_tag_cannot_close_higher_priority_element():
    x, _, _, _ = _xml("<b><div>x</b>y</div>")
    assert "<div _nid=\"3\">xy</div>" in x


def test_element_spans_are_outer_html():
    html = '<html><body><div class="k"><a href="/f ü">t</a></div></body></html>'
    assert _outer(html, 2) == '<div class="k"><a href="/f%20%C3%BC">t</a></div>'
    assert _outer(html, 3) == '<a href="/f%20%C3%BC">t</a>'


tags = st.sampled_from(["p", "div", "b", "li", "ul", "br", "a", "span", "td", "tr", "table", "script",
                        "title", "html", "body", "head", "x:y", "1bad", "h1"])
pieces = st.one_of(
    tags.map(lambda t: f"<{t}>"), tags.map(lambda t: f"</{t}>"),
    st.text(max_size=8), st.just("&amp;"), st.just("&nbsp;"), st.just("<!-- c -->"),
    st.just('<a href="x" href="y" q>'), st.just("<br/>"), st.just("\x00\x0b"),
)


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, max_size=30).map("".join))
def test_any_tag_soup_is_well_formed(html):
    x, h, starts, lens = _xml(html)
    assert len(starts) == len(lens) == x.count("_nid=")
    for s, n in zip(starts, lens):
        assert h[s - 1: s - 1 + n].startswith("<")


def test_every_output_is_well_formed():
    import xml.etree.ElementTree as ET

    from hypothesis import given, settings
    from hypothesis import strategies as st

    from pagemill.functions.htmlnorm import normalize

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet="<>!-/ab=\"'& ;?p\n", max_size=80), st.text(max_size=20))
    def check(a, b):
        for html in (a, b, f"<!-- --- nav --- -->{a}", f"<!--{a}-->", f"<p>{a}<!--{b}"):
            ET.fromstring(normalize(html)[0])

    check()
