"""Long and badly nested inputs take time and memory in proportion to their length."""

import time

from starforge.llm import op2_tokens
from starforge.llm.op7_html import parse


def _seconds(html):
    t = time.process_time()
    parse(html)
    return time.process_time() - t


def test_parsing_is_linear():
    for bit in ("<b>x", "<a ", '<a "', "<span>x<p>", "<li><b>", "<td><div><i></td>", "</b><p>"):
        _seconds(bit * 1000)
        assert _seconds(bit * 40_000) < 5, bit  # quadratic parsing takes minutes


def test_places_of_open_elements():
    def shape(e):
        return e if isinstance(e, str) else [e.tag, *map(shape, e.parts)]

    assert shape(parse("<ul><li>a<li>b</ul>c")) == ["html", ["ul", ["li", "a"], ["li", "b"]], "c"]
    assert shape(parse("<p>a<div>b</p>c</div>d")) == ["html", ["p", "a"], ["div", "b", "c"], "d"]
    assert shape(parse("<b>a<div>b</b>c</div>d")) == ["html", ["b", "a", ["div", "b", "c"], "d"]]
    assert shape(parse("a <!-- b > c")) == ["html", "a "]
    assert shape(parse("a < b <!-- c")) == ["html", "a < b "]


class Counts(dict):
    def __missing__(self, word):
        return len(word)


def test_scan_holds_each_chunk_once(monkeypatch):
    held = []
    compose = op2_tokens.compose
    monkeypatch.setattr(op2_tokens, "compose", lambda c, a, b: held.append(len(a[0]) + len(b[0])) or compose(c, a, b))
    maps = [("x" * 10, 0, None)] * 1000
    assert op2_tokens.scan(Counts(), maps)[-1] == ("x" * 10_000, 0, None)
    assert sum(held) <= 10_000 * 11  # the text once a round, 10 rounds
