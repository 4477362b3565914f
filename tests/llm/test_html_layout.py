"""Visible text and layout, against hand-worked renderings."""

from __future__ import annotations

import random
import re

import pytest

from churnlens.llm.html_layout import extract_text, visible_text

CASES = {
    "one <b>two</b>\n three": "one two three",
    "<p>a<p>b<div>c</div>d": "a\n\nb\n\nc\nd",
    "<h1>T</h1>x<br>y<hr>z": "T\n\nx\ny\n\nz",
    "<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>e": "- a\n- b\n  3. c\n  4. d\n\ne",
    "<ul><li><p>a<p>b</ul>": "- a\n\n  b",
    "<table><tr><th>Name<th>N<tr><td>pear<td>12<tr><td>a</table>": "Name  N\npear  12\na",
    "<table><tr><td rowspan=2>A<td>b<tr><td>c</table>": "A  b\n   c",
    "<table><tr><td colspan=2>wide one<td>z<tr><td>1<td>2<td>3</table>": "wide one  z\n1  2  3",
    "<table><caption>C</caption><tbody><tr><td>1<br>2<td>x</tbody></table>": "C\n1  x\n2",
    "<table><tr><td><table><tr><td>i<td>j</table><td>k</table>": "i  j  k",
    "<pre> a\n  b </pre>c": " a\n  b\n\nc",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n  d\nu",
    "x<script>var a='</p>';</script><style>p{}</style><!-- c --><template>t</template>y": "xy",
    "<div hidden>no</div><p style='color:red; DISPLAY : none'>no</p><input type=hidden value=v>yes": "yes",
    "<span style='visibility:hidden'>no</span><img alt='pic'><input value=go>": "pic go",
    "a<!-- never ends <p>b": "a",
    "&lt;b&gt; &amp;copy; &#233;&nbsp;x": "<b> &copy; é x",
    "<a href=x>l</a></p></div><b>open<i>both": "lopenboth",
    "<p>1</p></li></ul>2": "1\n\n2",
    "<select><option>a<option>b</select>": "a\nb",
    "": "",
    "plain": "plain",
    "< 3 and > 2 <": "< 3 and > 2 <",
}

HEADS = {
    "<html><head><title>T</title><body><p>Hello</body></html>": "Hello",
    "<html><head><title>T</title></head><body><p>Hello</body></html>": "Hello",
    "<head/><p>Hello": "Hello",
    "<head><title>T</title><p>Hello": "Hello",
    "<head><meta charset=utf-8><style>p{}</style><script>x</script>Hello<p>you": "Hello\n\nyou",
    "<head><noscript><p>no</noscript><template>no</template><h1>Hello</h1>you": "Hello\n\nyou",
    "<html><title>T</title><link rel=x>Hello<head>you</head> there": "Helloyou there",
}

TABLES = {
    "<table><tbody><form><tr><td>x</table>": "x",
    "<table><form><tr><td>x<td>y<tr><td>z</form></table>after": "x  y\nz\n\nafter",
    "<table><tr><form><td>x</td><td>y</td></form></tr></table>": "x  y",
    "<form><table><form><tr><td>x</form><tr><td>y</table></form>z": "x\ny\n\nz",
    "<table><tbody>note<tr><td>x</table>": "note\nx",
    "<table><tbody><div>note</div><tr><td>x</table>": "note\nx",
    "<table><thead>a<b>b</b></thead><tbody><tr><td>x</tbody><tfoot><p>c</p></table>": "ab\n\nc\nx",
    "<table><tbody><div>note<tr><td>x<tr><td>y</table>": "note\nx\ny",
    "<table><tr><td>x<tbody><span>note<td>y</table>": "note\nx\ny",
    "<table><tr><div>note<td>x</table>": "note  x",
    "<table><div>note<tbody><tr><td>x</table>": "note\nx",
    "<table><colgroup><col><col><tr><td>x<td>y</table>": "x  y",
    "<table><colgroup>note<caption>C</caption><tr><td>x</table>": "note\nC\nx",
    "<table><tbody hidden>no<div>no</div><tr><td>no</table>yes": "yes",
    "<table><tbody><template><tr><td>no</template><tr><td>x</table>": "x",
    "<table><tr><td><table><tbody>note<tr><td>i</table><td>k</table>": "note  k\ni",
}

SHOWN = {
    "if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then": "if x=1 then",
    "<math><semantics><mrow><mi>a</mi></mrow><annotation>no</annotation></semantics></math>b": "ab",
    "<math><mfrac><mn>1</mn><mn>2</mn></mfrac><mphantom><mi>no</mi></mphantom><mspace/><mi>z</mi></math>": "1 2 z",
    "a<math display=block><mi>x</mi></math>b": "a\nx\nb",
    "<p>a<svg viewBox='0 0 1 1'>no<title>no</title><desc>no</desc><path d=M0/><text x=1>La<tspan>bel</tspan></text></svg>b": (
        "a Label b"
    ),
    "<svg><g><text>one</text>no<text><tspan x=0>two</tspan><tspan x=0>three</tspan></text></g></svg>": "one two three",
    "<svg><defs><text>no</text></defs><style>p{}</style><text display=none>no</text><text><![CDATA[a<b]]></text></svg>": "a<b",
    "<svg><switch><foreignObject><div>html</div></foreignObject><text>no</text></switch></svg>": "html",
    "<svg><path d=M0><p>after</p>": "after",
    "<table><colgroup><col><svg><text>x</text></svg><tr><td>y</table>": "x\ny",
    "<p>a<svg><foreignObject><p>b</p>c</foreignObject><text>d</text></svg>e": "a\n\nb\n\nc d e",
    "<table><tr><td><svg><text>x</text></svg><td><math><mi>y</mi></math></table>": "x  y",
    "<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b><img alt=no></div>": "yes",
    "<div style='visibility:hidden; visibility:visible'>yes</div><div style='visibility:hidden!important;visibility:visible'>no": "yes",
    "<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>": "- yes",
    "<table style='visibility:hidden'>no<tr><td>no<td style='visibility:visible'>yes</table>": "  yes",
    "<table><tr><td style='visibility:hidden'>hid<td>b<tr><td>a<td>c</table>": "   b\na  c",
    "<table><tr style='visibility:collapse'><td>no<tr><td>a</table>": "a",
    "<pre style='visibility:hidden'>no</pre><pre>a</pre>": "a",
    "<div style='display:none'><b style='visibility:visible'>no</b></div>yes": "yes",
}


BROWSER = {
    "<details><summary>more</summary><p>no</details>a": "more\na",
    "<details open><summary>more</summary>yes</details>": "more\nyes",
    "<details>no<summary>s1</summary><summary>no</summary></details>a": "s1\na",
    "<input type=password value=secret><input type=checkbox value=on><input type=radio value=r>x": "x",
    "<input type=file value=f><input type=range value=3><input type=color value='#fff'>x": "x",
    "<input type=image alt=map value=v><input type=submit value=Go><input type=unheard value=t><input value=u>": "map Go t u",
    "x<br><br>y": "x\n\ny",
    "x<br> <br><br>y<br>z": "x\n\ny\nz",
    "<p>a<br></p><p>b": "a\n\nb",
    "<br>a": "a",
    "<div>a</div><br><div>b</div>": "a\n\nb",
    "<xmp><b>bold</b> &amp; </xmp>c": "<b>bold</b> &amp;\n\nc",
    "a<plaintext><p>b</p></plaintext> &lt;": "a\n\n<p>b</p></plaintext> &lt;",
    "<ol start='-2'><li>a<li>b<li>c<li>d</ol>": "-2. a\n-1. b\n0. c\n1. d",
    "<ol reversed><li>a<li>b<li hidden>no<li>c</ol>": "3. a\n2. b\n1. c",
    "<ol reversed start=10><li>a<li>b</ol>": "10. a\n9. b",
    "<ol><li>a<li value=5>b<li>c<li value=x>d</ol>": "1. a\n5. b\n6. c\n7. d",
    "<ul><li value=5>a</ul>": "- a",
    "<p style='display:none;display:block'>yes</p><p style='display:block;display:none'>no": "yes",
    "<p style='display:none!important;display:block'>no</p><p style='display:none;display:nonsense'>no</p>yes": "yes",
    "<p style='xdisplay:none'>yes</p><p style='display : inline flex'>and</p>": "yes\n\nand",
    "<div style='white-space:pre'>a  b\n   c</div>d": "a  b\n   c\nd",
    "<p>x <span style='white-space: pre-wrap'>1   2\n 3</span> y": "x 1   2\n 3 y",
    "<div style='white-space:pre-line'>a   b\nc</div>": "a b\nc",
    "<div style='white-space:pre'>a  b<p style='white-space:normal'>c   d</div>": "a  b\n\nc d",
    "<pre style='white-space:normal'>a   b\nc</pre>": "a b c",
    "<table style='white-space:pre'><tr><td>a  b<td>c</table>": "a  b  c",
    "<table><tr><td>b<tfoot><tr><td>f<thead><tr><td>h</table>": "h\nb\nf",
    "<table><tfoot><tr><td>f</tfoot><tbody><tr><td>b</tbody><thead><tr><td>h</thead><thead><tr><td>2</table>": "h\nb\n2\nf",
}


@pytest.mark.parametrize("html", BROWSER)
def test_as_a_browser_shows_it(html):
    assert visible_text(html) == BROWSER[html]


class Generated:
    """A random tree, its markup, and the words that show, in order, told from the tree alone."""

    INLINE = ("b", "i", "span", "a", "code", "em", "font")
    BLOCK = ("div", "section", "article", "blockquote", "main", "center", "form", "fieldset")
    GONE = ("script", "style", "template", "title", "noscript", "iframe", "audio")

    def __init__(self, seed):
        self.rng, self.n = random.Random(seed), 0
        self.markup, self.words = self.flow(4, True, True)

    def word(self, shown):
        self.n += 1
        return f" w{self.n} ", [f"w{self.n}"] if shown else []

    def flow(self, depth, there, seen):
        parts, words = [], []
        for _ in range(self.rng.randint(1, 4)):
            text, own = self.node(depth, there, seen)
            parts.append(text)
            words += own
        return "".join(parts), words

    def node(self, depth, there, seen):
        kind = self.rng.choice(["word", "word", "inline", "block", "list", "table", "gone", "style", "details", "comment"])
        if kind == "word" or not depth:
            return self.word(there and seen)
        if kind == "comment":
            return "<!-- no <b>words</b> -->", []
        if kind == "gone":
            return "<{0}> no </{0}>".format(self.rng.choice(self.GONE)), []
        if kind == "inline":
            parts = [self.word(there and seen) for _ in range(2)]
            tag = self.rng.choice(self.INLINE)
            return f"<{tag}>{''.join(p for p, _ in parts)}</{tag}>", [w for _, own in parts for w in own]
        if kind == "style":
            style, there2, seen2 = self.rng.choice(
                [
                    ("display:none", False, seen), ("display:none;display:block", there, seen), ("color:red", there, seen),
                    ("visibility:hidden", there, False), ("visibility:visible", there, True), ("display:block; visibility:collapse", there, False),
                ]
            )
            text, words = self.flow(depth - 1, there2, seen2)
            return f"<div style='{style}'>{text}</div>", words
        if kind == "details":
            head, words = self.word(there and seen)
            is_open = self.rng.random() < 0.5
            text, more = self.flow(depth - 1, there and is_open, seen)
            return f"<details{' open' * is_open}><summary>{head}</summary>{text}</details>", words + more
        if kind == "list":
            items = [self.flow(depth - 1, there, seen) for _ in range(self.rng.randint(1, 3))]
            end = self.rng.choice(["", "</li>"])
            return "<ul>" + "".join(f"<li>{t}{end}" for t, _ in items) + "</ul>", [w for _, own in items for w in own]
        if kind == "table":
            rows = [[self.word(there and seen) for _ in range(self.rng.randint(1, 3))] for _ in range(self.rng.randint(1, 3))]
            text = "".join("<tr>" + "".join(f"<td>{t}" for t, _ in row) for row in rows)
            return f"<table>{text}</table>", [w for row in rows for _, own in row for w in own]
        text, words = self.flow(depth - 1, there, seen)
        tag = self.rng.choice(self.BLOCK)
        return f"<{tag}>{text}</{tag}>", words


@pytest.mark.parametrize("seed", range(300))
def test_visible_words_of_generated_trees(seed):
    made = Generated(seed)
    assert re.findall(r"w[0-9]+|no", visible_text(made.markup)) == made.words


@pytest.mark.parametrize("html", SHOWN)
def test_formulas_drawings_and_visibility(html):
    assert visible_text(html) == SHOWN[html]


@pytest.mark.parametrize("html", TABLES)
def test_text_beside_rows(html):
    assert visible_text(html) == TABLES[html]


@pytest.mark.parametrize("html", HEADS)
def test_optional_head_tags(html):
    assert visible_text(html) == HEADS[html]


@pytest.mark.parametrize("html", CASES)
def test_rendering(html):
    assert visible_text(html) == CASES[html]


def test_deep_and_long():
    assert visible_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert visible_text("<ul><li>" * 3000 + "deep").endswith("deep")
    assert visible_text("<b>" * 3000 + "x <p>" * 3000).count("x") == 3000
    assert len(visible_text("<p>" + "word " * 100_000)) == 499_999


def test_table(spark):
    rows = [(1, "u", "<p>a"), (2, "u", None), (1, "u", "<p>a"), (None, None, ""), (3, "u", "<td>x")]
    df = spark.createDataFrame([(*r, "mine") for r in rows], "page_id long, url string, html string, text string")
    found = sorted(((r["page_id"], r["text"]) for r in extract_text(df).collect()), key=repr)
    assert found == sorted([(1, "a"), (2, ""), (1, "a"), (None, ""), (3, "x")], key=repr)
    assert extract_text(df.limit(0)).count() == 0
