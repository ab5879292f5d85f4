import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trajloom.llm.html_text import aligned, extracted, text_of

CASES = {
    "<p>a<p>b<div>c</div>d": "a\n\nb\n\nc\nd",
    "<ul><li>x<li>y<ol start=3><li>q<li>r</ol><li>z</ul>": "- x\n- y\n  3. q\n  4. r\n- z",
    "<ol><li>a<li value=7>b<li>c</ol>": "1. a\n7. b\n8. c",
    "<table><tr><th>k<th>value<tr><td>longer cell<td>1<br>2</table>t": "k           | value\nlonger cell | 1\n            | 2\n\nt",
    "<table><tr><td colspan=2>a<td>b<tr><td>c<td>d<td>e</table>": "a |   | b\nc | d | e",
    "a <b> b </b> c\n\td": "a b c d",
    "<pre> a\n  b</pre>c": " a\n  b\n\nc",
    "<div hidden>h</div><span style='color:red;display: none'>g</span><i style=visibility:hidden>i</i>x": "x",
    "<head><title>t</title></head><script>if(a<b)'</p>'</script><style>p{}</style>x<template>y</template>": "x",
    "<input type=hidden value=q><input type=submit value=Go><img alt='a pic' src=x>": "Go a pic",
    "<!-- c -->a<!-- <p>b</p> --><![CDATA[x]]>c": "ac",
    "&lt;b&gt; &amp;amp; &eacute;&#8364;": "<b> &amp; é€",
    "</div></p>a</span>b": "ab",
    "<table><tr><td><pre>x\n|ab|</pre><td>c</table>": "x    | c\n|ab|",
    "<table><tr><td>a<br>|<td>b</table>": "a | b\n|",
    "<div><table><tr><td>a</div>b<td>c</table>d</div>e": "ab | c\n\nd\ne",
    "<table><tr><td><p>a</p></table></table>b": "a\n\nb",
    "<dl><dt>t<dd>d1<dd>d2</dl>": "t\n    d1\n    d2",
    "<blockquote>q<p>r</blockquote>": "> q\n\n> r",
    "<select><option>a<option>b</select>": "a\nb",
    "<td>loose</td><td>cells": "loose cells",
    "<table><tr><td><table><tr><td>in</table><td>out</table>": "in | out",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<p>one</p>\n\n<p>two</p>": "one\n\ntwo",
    "1 < 2 <3": "1 < 2 <3",
    "<a href='x>y'>z</a>": "z",
    "": "",
    "<p></p>": "",
}


@pytest.mark.parametrize("page", CASES)
def test_rendering(page):
    assert text_of(page) == CASES[page]


def test_long_cells_keep_their_text():
    rows = aligned([[["x" * 500], ["a"]], [["y"], ["b"]]])
    assert rows == ["x" * 500 + " | a", "y | b"]


QUOTES = {
    '<a href="x"">Link</a> kept text <b class="y">bold</b> tail': "Link kept text bold tail",
    "<p title=it's>all the rest of the page": "all the rest of the page",
    "<p a='b' 'hidden'>shown": "shown",
    '<a href=x="y>z': "z",
    '<a href="x"class="y>">in</a>': "in",
    "<a href = 'x>y' b= \"q>\">z": "z",
}


@pytest.mark.parametrize("page", QUOTES)
def test_quotes_open_only_values(page):
    assert text_of(page) == QUOTES[page]


FOREIGN = {
    "a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b": "a x=2 b",
    "<math><semantics><mi>x</mi><annotation encoding=tex>\\x</annotation><annotation-xml><ci>q</ci></annotation-xml></semantics></math>y": "xy",
    "<math><mtable><mtr><mtd><mn>1</mn><mtd/><mtd><mn>2</mn></mtr></mtable><mphantom><mi>q</mi></mphantom></math>": "1 2",
    "<svg><title>t</title><desc>d</desc><metadata>m</metadata><defs><text>u</text></defs><text>Axis</text><text>Up</text></svg>z": "Axis\nUp\nz",
    "<svg><title/><defs/><style/><path d='M0'/><text>seen</text></svg>after": "seen\nafter",
    "<svg><style>a{b:c}</style><text><![CDATA[x < y]]> z</text></svg>": "x < y z",
    "<svg><foreignObject><p>one<p>two</foreignObject><script>q</script></svg>": "one\n\ntwo",
    "<svg><defs><p>out</p>": "out",
    "<desc>d</desc> <metadata>m</metadata>": "d m",
}


@pytest.mark.parametrize("page", FOREIGN)
def test_text_of_drawings_and_formulas(page):
    assert text_of(page) == FOREIGN[page]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("<p> </p> <li> <ul> </ul> <table> <tr> <td> </table> <pre> </pre> <div> </div> <b> <br> x y< & &amp; <script> </script> <a ' \" > \n".split(" ")), max_size=40))
def test_no_page_breaks_it(parts):
    text = text_of("".join(parts))
    assert "\n\n\n" not in text or "<pre>" in parts or "<br>" in parts


@pytest.mark.parametrize("page", ["<div>" * 30_000, "<p>" * 20_000 + "</div>" * 20_000, "<table><tr><td>" * 2_000 + "x", "<" * 50_000, "<a b='" * 20_000, "<ul><li>" * 2_000])
def test_hostile_pages_stay_linear(page):
    begun = time.process_time()
    text_of(page)
    assert time.process_time() - begun < 10


def test_table(spark):
    rows = [(1, "<p>a", "u"), (1, "<p>a", "u"), (2, None, "u"), (3, "", None), (None, "b" * 300_000, "u")]
    got = extracted(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "a"), (1, "a"), (2, None), (3, ""), (None, "b" * 300_000)], key=str)
    assert extracted(spark.createDataFrame([], "page_id long, html string")).count() == 0
