import pytest

from barwright.llm import html_wrapper as hw

SCHEMA = "page_id long, url string, html string"


def page(i, body, host_bits="Menu one", tail="All rights reserved by the host"):
    return (
        f'<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var a="</p>";</script></head><body>'
        f"<div><ul><li><a href='/a'>{host_bits}</a></li><li>Contact us</li></ul></div><!-- {i} -->"
        f"<div>{body}</div><div>{tail}</div></body></html>"
    )


def test_template_by_alignment(spark):
    """No telling tags: what is constant on the host goes, the slots stay."""
    rows = [(i, f"http://plain.example/{i}", page(i, f"<h2>Title {i}</h2><p>Body text number {i} &amp; more</p>" + "<p>tail</p>" * (i % 3))) for i in range(9)]
    rows += [(100 + i, f"https://other.example/{i}", page(i, f"<p>Other {i}</p>", "Start", "Imprint")) for i in range(5)]
    got = {r.page_id: r.text for r in hw.query(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    for i in range(9):
        assert got[i].startswith(f"Title {i}\nBody text number {i} & more")
        assert "Contact" not in got[i] and "rights" not in got[i] and "Menu" not in got[i]
    assert all(got[100 + i] == f"Other {i}" for i in range(5))


def test_copies_of_an_article_are_no_template(spark):
    same = "<article><h1>Same title</h1><p>The very same article.</p></article>"
    rows = [(i, "http://c.example/x", page(i, same)) for i in range(8)]
    rows += [(50 + i, "http://c.example/y", page(i, f"<article><p>Own text {i}</p></article>")) for i in range(4)]
    got = {r.page_id: r.text for r in hw.query(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == "Same title\nThe very same article." for i in range(8))
    assert all(got[50 + i] == f"Own text {i}" for i in range(4))


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain  words\n only", "plain words only"),
        ("<p>a<b>b</b> c<p>d<br>e</p>", "ab c\nd e"),
        ("<article><h1>H</h1><p><b>x y<br><p>next</article>", "H\nx y\nnext"),
        ("<body><nav>n</nav><header>h</header><main><p>m &lt;b&gt; &eacute;&#233;&nbsp;z</p></main><aside>s</aside><footer>f</footer>", "m <b> éé z"),
        ("<article><p>t</p><div class='share-buttons social'>s</div><form><input>q</form><section id='comments'><p>c</p></section></article>", "t"),
        ("<div class='cookie-notice'>c</div><p>a</p><div role='navigation'>r</div><p hidden>h</p><script>1<2</script><p>b", "a\nb"),
        ("<div class='has-sidebar'><div class='post-header'><h1>T</h1></div><p>a</p><div class='page-header'>x</div></div>", "T\na"),
        ("<ul><li>one<li>two</ul><table><tr><td>x<td>y<tr><td>z</table>", "one\ntwo\nx\ny\nz"),
        ("a < b and c > d <3", "a < b and c > d <3"),
        ("<p>unclosed <!-- comment", "unclosed"),
        ("<p title='a > b'>q</p><p data-x=\"<i>\">r</p>", "q\nr"),
        ("<article><pre>a\n  b</pre><blockquote>q<p>r</p></blockquote></article>", "a b\nq\nr"),
    ],
)
def test_single_pages(html, text):
    assert hw.main_text(hw.parse(html), set()) == text


def test_alignment_is_a_matching():
    a, b = hw.parse("<div><p>1</p><p>2</p><p>3</p><i>x</i></div>"), hw.parse("<div><p>0</p><p>1</p><p>3</p><i>x</i></div>")
    same = hw.same_nodes(a, b)
    assert len(set(same.values())) == len(same)
    assert {(k, v) for k, v in same.items() if k} == {(2, 3), (4, 4), (5, 5)}


def test_deep_and_long_pages():
    assert hw.main_text(hw.parse("<div>" * 5000 + "deep" + "</div>" * 5000), set()) == "deep"
    long = hw.parse("".join(f"<p>{i}</p>" for i in range(20_000)))
    assert hw.main_text(long, set()).count("\n") == 19_999
    for depth in (50, 70, 2000):
        a, b = (hw.parse("<div>" * depth + f"<p>same</p><i>{x}</i>") for x in "xy")
        assert hw.same_nodes(a, b) == {depth + 1: depth + 1}


def test_attributes_are_read_whole_and_by_name():
    for attrs in ('class="cookie-notice"', f'data-x="{"v" * 5000}" class="cookie-notice"', f'style="{"top:0;" * 300}display:none"', f"data-y='{'w ' * 400}' hidden"):
        assert hw.main_text(hw.parse(f"<body><div {attrs}>gone</div><p>stays</p></body>"), set()) == "stays"
    for attrs in ('data-class="cookie-notice"', 'title="see class=sidebar here"', "data-role=navigation", 'data-hidden="x"'):
        assert hw.main_text(hw.parse(f"<body><div {attrs}>a</div><p>b</p></body>"), set()) == "a\nb"


def test_odd_rows(spark):
    rows = [(1, None, None), (1, "http://h.example/1", "<p>a"), (1, "http://h.example/1", "<p>a"), (None, "", ""), (2, "no url", "<p>b</p>"), (3, None, "c")]
    df = spark.createDataFrame([(*r, "x", 1, "t", 0) for r in rows], SCHEMA + ", host string, n_chars long, text string, refs int")
    got = hw.query(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, None, "", 0), (1, "http://h.example/1", "a", 1), (1, "http://h.example/1", "a", 1), (None, "", "", 0), (2, "no url", "b", 1), (3, None, "c", 1)], key=str
    )
    assert hw.query(df.limit(0)).count() == 0


def test_references_by_join(spark, monkeypatch):
    monkeypatch.setattr(hw, "SMALL_BYTES", 0)
    rows = [(i, f"http://plain.example/{i}", page(i, f"<p>Body {i}</p>")) for i in range(6)]
    got = {r.page_id: r.text for r in hw.query(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"Body {i}" for i in range(6)}
