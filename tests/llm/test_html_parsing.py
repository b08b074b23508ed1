"""What a page's text is, against the rules of HTML and a plain parser; pages of any depth."""

import html
import random
import time
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest

from abacus.llm import html_blocks


def read(page):
    return [leaf.text for leaf in html_blocks.leaves(page)]


@pytest.mark.parametrize("page, want", [
    ("<script>x</script/><p>Article one.</p>", ["Article one."]),
    ("<style>x</style foo><p>Art two</p>", ["Art two"]),
    ('<style>x</style a="b>c"><p>Art</p>', ["Art"]),
    ("<script>a</scripty>b</script\n><p>c</p>", ["c"]),
    ("<script>never ends <p>x</p>", []),
    ("<!--><p>after</p>", ["after"]), ("<!---><p>after</p>", ["after"]),
    ("<!-- x --!><p>after</p>", ["after"]), ("<!-- x -- > y --><p>after</p>", ["after"]), ("a<!-- open <p>x</p>", ["a"]),
    ("<script src=/a/>var x=1;</script><p>t</p>", ["t"]), ('<script type="a"/>var y=2;</script><p>t</p>', ["t"]),
    ("<textarea/>typed</textarea><p>t</p>", ["t"]),
    ("<p>a &amp; b</p>", ["a & b"]), ("<p>&am<i>p;</i></p>", ["&amp;"]), ("<p>&lt;<b>p</b>&gt;</p>", ["<p>"]), ("<p>&amp;lt;</p>", ["&lt;"]),
    ("<svg><style/><title>T</title></svg><p>x</p>", ["T", "x"]), ("<svg a=b/><title>T</title></svg><p>x</p>", ["T", "x"]),
    ("<p>1 <svg/>2</p>", ["1 2"]), ("<p>a <object data=x/>b</p><p>c</p></object>", ["a b", "c"]),
    ("</div></p></section><p>x</p>", ["x"]), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("<dl><dt>t<dd>d<dt>u</dl>", ["t", "d", "u"]), ("<table><tr><td>1<td>2<tr><th>3</table>", ["1", "2", "3"]),
])
def test_ends_of_raw_text_comments_and_tags(page, want):
    assert read(page) == want


class Plain(HTMLParser):
    """Blocks of well-formed pages by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.held, self.skip = [], [], 0

    def cut(self):
        text = " ".join("".join(self.held).split())
        self.blocks += [text] if text else []
        self.held = []

    def handle_starttag(self, tag, attrs):
        if tag in html_blocks.RAW:
            self.skip += 1
        elif tag == "br":
            self.held.append(" ")
        elif tag not in html_blocks.INLINE:
            self.cut()

    def handle_endtag(self, tag):
        if tag in html_blocks.RAW:
            self.skip -= 1
        elif tag not in html_blocks.INLINE and tag != "br":
            self.cut()

    def handle_data(self, data):
        if not self.skip:
            self.held.append(data)


def test_well_formed_pages_equal_a_plain_parser():
    rng = random.Random(4)

    def inline(depth):
        kind = rng.randrange(8)
        if depth > 3 or kind < 4:
            return rng.choice(["word ", "two words", " ", "a&nbsp;b ", "&eacute;t&eacute;", "x &lt; y ", html.escape("<p>no</p> & 'so'"), "\n  "])
        if kind == 4:
            return "<br>"
        if kind == 5:
            return rng.choice(["<!-- c <p>x</p> -->", "<script>if (a < b) '<p>'</script>", "<style>p{}</style>"])
        tag = rng.choice(["b", "a", "span", "em", "code"])
        return f'<{tag} class="x > y" id=z>' + "".join(inline(depth + 1) for _ in range(rng.randint(0, 3))) + f"</{tag}>"

    def block(depth):
        if depth > 4 or rng.random() < 0.4:
            return "<p>" + "".join(inline(0) for _ in range(rng.randint(0, 5))) + "</p>"
        tag = rng.choice(["div", "section", "article", "ul", "nav"])
        inner = "".join(block(depth + 1) for _ in range(rng.randint(0, 4)))
        return f"<{tag} class='c'>{''.join(inline(2) for _ in range(rng.randint(0, 1)))}{inner}</{tag}>"

    for _ in range(300):
        page = "<body>" + "".join(block(0) for _ in range(4)) + "</body>"
        plain = Plain()
        plain.feed(page)
        plain.close()
        plain.cut()
        assert read(page) == plain.blocks, page


@pytest.mark.parametrize("unit", ["<div>word ", "<p>w<div class=a>x", "<li><div>w", "<object>w ", "</section><b>w</p>", "<table><tr><td>w", "<svg><g>w", "<body>w"])
def test_deep_or_unclosed_nesting_is_linear(unit):
    """A page eight times as long takes about eight times as long, not 64 times."""
    def seconds(n):
        begun = time.process_time()
        found = html_blocks.vectors(html_blocks.leaves(unit * n))
        assert np.isfinite(found).all()
        return time.process_time() - begun

    seconds(200)
    short = min(seconds(2000) for _ in range(2))
    assert seconds(16_000) < max(25 * short, 1.0) and seconds(8000) < 5


def test_path_vectors_count_tokens():
    leaf = html_blocks.leaves('<div class="a b"><div><section><ul><li><p>text')[0]
    tokens, node = [], leaf.path
    while node.parent is not None:
        tokens.append(node.token)
        node = node.parent
    assert tokens == ["p", "li", "ul", "section", "div", "b", "a", "div"]
    plain = np.zeros(html_blocks.PATH_SIZE)
    for depth, token in enumerate(tokens):
        plain[zlib.crc32(token.encode()) % html_blocks.PATH_SIZE] += 1.0 if depth < 4 else 0.7
    assert np.allclose(leaf.path.vector(), np.minimum(plain, 2))
