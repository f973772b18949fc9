from __future__ import annotations

import random

import pytest

from granary.llm import html_extract


def brute_length(a: list, b: list) -> int:
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("cells", [1 << 28, 6])
def test_longest_common_subsequence(monkeypatch, cells):
    monkeypatch.setattr(html_extract, "CELLS", cells)
    draw = random.Random(3)
    for _ in range(3000):
        a = [draw.randint(0, 5) for _ in range(draw.randint(0, 12))]
        b = [draw.randint(0, 5) for _ in range(draw.randint(0, 12))]
        places = html_extract.common(a, b)
        rest = iter(b)
        assert places == sorted(set(places)) and len(places) == brute_length(a, b)
        assert all(any(x == a[i] for x in rest) for i in places)


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b</p>c", "a\nb\nc"),
        ("<div>x<br>y &nbsp; z</div>", "x y z"),
        ("<p>one<b>two</p><p>three</b> four", "onetwo\nthree four"),
        ("<p>a<!-- <p>no</p> -->b</p>", "ab"),
        ("<p>1 < 2 &lt;b&gt; &#233;&eacute;</p>", "1 < 2 <b> éé"),
        ("<script>var t='</p>';</script><style>p{}</style><p>k</p>", "k"),
        ("<head><title>t</title><body><p>k", "k"),
        ("<nav>m</nav><header>h</header><p>k</p><aside>s</aside><footer>f</footer><form>q</form>", "k"),
        ("<p>k</p><div class='cookie-notice'>n</div><div id=comments><p>c</p></div><div class=ad>x</div>", "k"),
        ("<p hidden>x</p><p style='display: none'>y</p><p>k</p>", "k"),
        ("<p>outside</p><article><h1>T</h1><p>k</p><section class=comments><article>c</article></section></article>", "T\nk"),
        ("<article><header><h1>T</h1>by me</header><p>k</p><footer>tags</footer></article>", "T\nk"),
        ("<main><p>k</p></main><div><p>other</p></div>", "k"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>", "a\nb\n1\n2"),
        ("<p>open <i>a</i>, <a href='x>y'>b</a>.", "open a, b."),
        ("<div class=ad>x<br><p>y", ""),
        ("<body class='has-sidebar comments-open'><div class='no-ads content'><p>k</p></div>", "k"),
        ("<p>k</p><div class=cookieNotice>n</div><div id='sideBar' role=complementary>s</div>", "k"),
        ("<article class='post comments-open'><p>k</p><div class=footer>f</div></article>", "k"),
        ("<article class=comment><p>c</p></article><p>k</p>", "k"),
        ("<textarea><p>no</p></textarea><p>k<", "k<"),
    ],
)
def test_marks(page, text):
    assert html_extract.main_text(page, []) == text


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, _key string")


def test_lines_shared_with_the_nearest_page_go(spark):
    frame = "<div>Our site</div><p>{}</p><p>Second {}</p><div>Write to us</div>"
    rows = [(i, f"http://h.example/a/{i}.html", frame.format(f"story {i}", i), "old", "k") for i in range(6)]
    rows += [(10, "https://alone.example/x", frame.format("alone", 10), "old", "k")]
    marked = "<div>Our site</div><article><p>Same text</p></article>"
    rows += [(20 + i, f"http://h.example/b/{i}", marked, "old", "k") for i in range(2)]
    got = {r.page_id: r for r in html_extract.extract(pages(spark, rows).repartition(4)).collect()}
    assert all(got[i].text == f"story {i}\nSecond {i}" and got[i].n_shared == 2 for i in range(6))
    assert got[10].text == "Our site\nalone\nSecond 10\nWrite to us"
    assert got[20].text == got[21].text == "Same text"
    assert got[20].n_chars == 9 and got[20]._key == "k"


def test_partners_do_not_depend_on_the_slices(spark):
    draw = random.Random(5)
    rows = [(f"h{draw.randint(0, 3)}", f"/p/{draw.randint(0, 500)}", i) for i in range(200)]
    frame = spark.createDataFrame(rows, "_host string, _path string, _key long")
    one = {r._key: r._partner for r in html_extract.partners(frame.coalesce(1)).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 17)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        many = {r._key: r._partner for r in html_extract.partners(frame.repartition(9)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert one == many
    order = sorted(rows)

    def near(a: str, b: str) -> int:
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    for at, (host, path, key) in enumerate(order):
        sides = [order[i] for i in (at - 1, at + 1) if 0 <= i < len(order) and order[i][0] == host]
        if not sides:
            assert one[key] is None
        else:
            best = max(near(path, side[1]) for side in sides)
            assert one[key] == next(side[2] for side in sides if near(path, side[1]) == best)


def test_copies_without_an_article_mark_keep_their_text(spark):
    frame = "<div class=ad>{}</div><div>Our site</div><p>{}</p><p>Second {}</p><div>Write to us</div>"
    story = [frame.format("ad", f"story {i}", i) for i in range(4)]
    urls = ["http://h.example/a/1", "https://h.example/a/1", "http://h.example/a/1?from=x", "http://h.example/a/1#top"]
    rows = [(i, url, story[0], "old", "k") for i, url in enumerate(urls)]
    rows += [(4, urls[0], story[0], "old", "k"), (5, urls[0], frame.format("other ad", "story 0", 0), "old", "k")]
    rows += [(10 + i, f"http://h.example/a/{i + 1}", story[i], "old", "k") for i in range(1, 4)]
    rows += [(20 + i, f"http://copies.example/{i}", story[1], "old", "k") for i in range(3)]
    got = {r.page_id: r for r in html_extract.extract(pages(spark, rows).repartition(4)).collect()}
    assert all(got[i].text == "story 0\nSecond 0" for i in range(6))
    assert all(got[10 + i].text == f"story {i}\nSecond {i}" for i in range(1, 4))
    assert all(got[20 + i].text == "Our site\nstory 1\nSecond 1\nWrite to us" for i in range(3))


def test_partners_are_the_nearest_of_other_content(spark):
    draw, long = random.Random(9), "x" * 300
    rows, at = [], 0
    while at < 400:  # runs of equal contents, some longer than a slice
        for _ in range(draw.choice([1, 1, 2, 60])):
            rows.append((f"h{at // 150}", f"/{long}{at:05d}{draw.choice(['', 'a', 'ab'])}", at, 0))
            at += 1
        rows[-1] = (*rows[-1][:3], draw.randint(1, 2))
    frame = spark.createDataFrame(rows, "_host string, _path string, _key long, _content long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 23)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r._key: r._partner for r in html_extract.partners(frame.repartition(9), "_content").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    def near(a: str, b: str) -> int:
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    order = sorted(rows)
    for at, (host, path, key, content) in enumerate(order):
        unlike = [[r for r in side if r[0] == host and r[3] != content][:1] for side in (order[:at][::-1], order[at + 1 :])]
        sides = unlike[0] + unlike[1]
        best = max((near(path, side[1]) for side in sides), default=-1)
        assert got[key] == next((side[2] for side in sides if near(path, side[1]) == best), None)


def test_odd_pages(spark):
    rows = [(1, None, "<p>a</p>", "t", "k"), (1, None, "<p>a</p>", "t", "k"), (None, "not a url", None, None, None),
            (2, "http://x.example", "", "t", "k"), (3, "http://x.example/l", "<p>w</p>" * 20_000, "t", "k")]
    got = html_extract.extract(pages(spark, rows)).collect()
    assert len(got) == 5
    assert sorted(r.n_chars for r in got) == [0, 0, 1, 1, 39_999]
    assert html_extract.extract(pages(spark, [])).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><h2 id='promotion-of-trade'>Trade</h2><h3 id='related-work'>Work</h3><p id='search'>s</p></article>", "Trade\nWork\ns"),
        ("<article><div class='share-price'>9</div><table class='search-results'><tr><td>r</table></article>", "9\nr"),
        ("<main><h1 id='menu'>Menu planning</h1><div class='recipe-notice'>n</div></main>", "Menu planning\nn"),
        ("<h2 id='newsletter-history'>H</h2><p id='footer-notes'>k</p><p class='cookie-notice'>c</p>", "H\nk"),
        ("<article id='ad-astra'><p>k</p><div class='comment-list'>c</div><div class='share-buttons'>b</div></article>", "k"),
        ("<article><div class='ad'>a</div><div id='comments'>c</div><p class='comments'>kept</p></article>", "kept"),
        ("<article><p>k</p></article><article class='related-posts'><p>r</p></article>", "k"),
        ("if a<b and c<d then", "if a<b and c<d then"),
        ("<p>a</p> <b 'x> <i>t</i>", "a\n<b 'x> t"),
        ("<p>a <svg/> b</p>", "a b"),
        ("<b><div><i>x</b>y</i></div>z", "xy\nz"),
    ],
)
def test_only_whole_marks_count_inside_an_article(page, text):
    assert html_extract.main_text(page, []) == text


def slow_tags(page: str):
    """The tags by the pattern that defines them, however long it takes."""
    import re

    pattern = re.compile(
        r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>\"']*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
    )
    at = 0
    while m := pattern.search(page, at):
        yield m.start(), m.end(), m[1] or "", (m[2] or "").lower(), m[3] or ""
        at = m.end()


def test_tags_against_their_pattern():
    draw = random.Random(11)
    bits = ["<a ", "<b>", "</b>", "<p", ">", "'", '"', "x=", " ", "t", "<!--", "-->", "<!d", "<?p", "/", "<", "</p>", "<div class='q'>"]
    for _ in range(4000):
        page = "".join(draw.choice(bits) for _ in range(draw.randint(0, 25)))
        tags, at, found = html_extract.Tags(page), 0, []
        while tag := tags.after(at):
            found.append(tag)
            at = tag[1]
        assert found == list(slow_tags(page)), page


def slow_lines(page: str) -> list[tuple[str, int]]:
    """Lines and kinds with a plain list of open elements, searched from its top each time."""
    import html

    h, lines, held, stack, at = html_extract, [], [], [], 0

    def kind():
        return stack[-1][1:] if stack else (h.OPEN, False)

    def flush():
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            lines.append((text, kind()[0]))
        held.clear()

    for start, end, slash, name, source in slow_tags(page):
        if start < at:
            continue
        held.append(page[at:start])
        at = end
        if slash:
            if name in h.BLOCKS:
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    if any(s[0] in h.BLOCKS for s in stack[depth:]) or (stack[depth - 1][1] if depth else h.OPEN) != kind()[0]:
                        flush()
                    del stack[depth:]
                    break
                if name not in h.BLOCKS and stack[depth][0] in h.BLOCKS:
                    break
        elif name in h.VOID:
            if name == "hr":
                flush()
            held.append(" ")
        elif name:
            if name in h.BLOCKS:
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if name in h.CLOSED_BY.get(stack[depth][0], ()):
                    del stack[depth:]
                    break
                if stack[depth][0] in h.SCOPE:
                    break
            inner = h._kind(name, source, *kind())
            if inner[0] != kind()[0]:
                flush()
            stack.append((name, *inner))
    held.append(page[at:])
    flush()
    return lines


def test_lines_against_a_slow_reader():
    draw = random.Random(12)
    names = ["p", "b", "i", "div", "li", "ul", "td", "tr", "table", "article", "span", "h2", "section", "nav", "main"]
    marks = ["", "", "", " class='comments'", " id='related-work'", " class='ad'", " class='share-price'", " class='sidebar'"]
    for _ in range(3000):
        page = ""
        for _ in range(draw.randint(1, 30)):
            name = draw.choice(names)
            page += draw.choice([f"<{name}{draw.choice(marks)}>", f"</{name}>", "word ", "x &amp; y", "<br>", "<hr>"])
        assert html_extract.lines_of(page) == slow_lines(page), page


@pytest.mark.parametrize(
    "part", ["<a ", "if a<b and c<d then ", "<span>", "</span>", "<a \">\" ", "<a '", "<svg/>", "<p ", "<b><div>", "<!x ", "a&lt;"]
)
def test_ten_megabytes_of_broken_markup(part):
    import time

    page = "<article><p>k</p>" + part * (10_000_000 // len(part))
    began = time.monotonic()
    html_extract.lines_of(page)
    assert time.monotonic() - began < 60


def test_end_tags_that_match_nothing_near():
    import time

    began = time.monotonic()
    for page in ("<b><div>" + "<span>" * 100_000 + "</b>" * 100_000, "<span>" * 100_000 + "<li></li>" * 100_000,
                 "<span>" * 100_000 + "</i>" * 100_000):
        html_extract.lines_of(page)
    assert time.monotonic() - began < 30


def test_differencing_alone_finds_the_story(spark):
    """Pages without an article mark, whose template has no marks either: what differs is the story."""
    draw = random.Random(13)
    words = [f"w{i}" for i in range(500)]
    said = lambda n: " ".join(draw.choices(words, k=n))
    rows, wanted = [], {}
    for host in range(6):
        template = [said(4) for _ in range(8)]
        for page in range(20):
            story = [said(12) for _ in range(draw.randint(3, 9))]
            key = host * 100 + page
            wanted[key] = story
            blocks = [*template[:4], *story, *template[4:]]
            rows.append((key, f"http://h{host}.example/{page % 3}/{page}", "".join(f"<div>{b}</div>" for b in blocks), "t", "k"))
    hit = kept = told = 0
    for row in html_extract.extract(pages(spark, rows)).collect():
        lines = row.text.split("\n")
        hit += len(set(lines) & set(wanted[row.page_id]))
        kept += len(lines)
        told += len(wanted[row.page_id])
    assert hit / kept > 0.99 and hit / told > 0.99
