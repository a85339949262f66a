import random

import pytest

from weirframe.llm import html_render
from weirframe.llm.html_render import text_of
from weirframe.llm.queries import op2_html_text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain <3 a < b", "plain <3 a < b"),
        ("<p>One<p>Two<br>three", "One\n\nTwo\nthree"),
        ("<div>a</div><div>b  <b>c</b> d</div>", "a\nb c d"),
        ("<h1>H &amp; &eacute;</h1>x", "H & é\n\nx"),
        ("a<!-- <p>no</p> -->b<script>'</p>'</script>c<style>p{}</style>d", "abcd"),
        ("<head><title>T</title></head><body>b", "b"),
        ("<div hidden>n</div><p style='display : none'>n</p><i style=\"visibility:hidden\">n</i>y", "y"),
        ("<template>n</template><noscript>n</noscript><details><summary>s</summary>n</details>y", "s\ny"),
        ("<details open><summary>s</summary>m</details>", "s\nm"),
        ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>", "- a\n- b\n  3. c\n  4. d\n- e"),
        ("<table><tr><th>Name<th>N<tr><td>x<td>10<tr><td>longer<td>2</table>", "Name    N\nx       10\nlonger  2"),
        ("<table><tr><td colspan=2>wide<td>c<tr><td>a<td>b<td>c</table>", "wide  c\na  b  c"),
        ("<table><td>a<p>b<td>c</table>d", "a  c\n\nb\n\nd"),
        ("<table><tr><td>a<br>b<td>c<tr><td>d<td>e</table>", "a  c\nb\nd  e"),
        ("<table><tr><td rowspan=2>s<td>1<tr><td>2<tr><td>t<td>3</table>", "s  1\n   2\nt  3"),
        ("<table><tr><td colspan=2>much wider<td>z<tr><td>a<td>b<td>c</table>", "much wider  z\na  b        c"),
        ("<table><tr><td>漢字<td>x<tr><td>ab<td>y</table>", "漢字  x\nab    y"),
        ("<table><tr><td><table><tr><td>1<td>2</table><td>menu</table>", "1  2\nmenu"),
        ("<p style='visibility:hidden'>n<b style='visibility:visible'>y</b>n</p>", "y"),
        ("<svg><title>n</title><text>one</text><text>two</text><desc>n</desc></svg>", "one\ntwo"),
        ("<ol><li value=5>a<li>b</ol>", "5. a\n6. b"),
        ("<ol reversed><li>a<li>b<li value=9>c<li>d</ol>", "4. a\n3. b\n9. c\n8. d"),
        ("<style>.x{display:none} p.y , #z{visibility:hidden}@media print{b{display:none}} /* i{display:none} */</style>"
         "<p class='a x'>n</p><p class=y>n</p><i class=y>m</i><u id=z>n</u><b>o</b>", "mo"),
        ("<style>.x{display:none} #q{display:block}</style><i class=x id=q>a</i><i class=x style='display:inline'>b</i>", "ab"),
        ("<pre>  a\n   b</pre>c", "  a\n   b\n\nc"),
        ("<blockquote>q</blockquote>t", "  q\n\nt"),
        ("<p><b>x<p>y</b>z", "x\n\nyz"),
        ("</div></p>x</span>", "x"),
        ("<textarea> a  b</textarea>", " a  b"),
        ("<script>never closed <p>x", ""),
        ("<a href='x>y'>in</a>", "in"),
    ],
)
def test_rendering(page, text):
    assert text_of(page) == text


def painted(table):
    """A table laid out on a canvas: cells are put on a grid of characters one by one."""
    taken, spots, n = set(), [], len(table)
    for r, row in enumerate(table):
        c = 0
        for text, across, down in row:
            while any((r, x) in taken for x in range(c, c + across)):
                c += 1
            down = min(down or n, n - r)
            taken |= {(y, x) for y in range(r, r + down) for x in range(c, c + across)}
            if text:
                spots.append((r, c, down, across, text.split("\n")))
    columns = max((c + across for _, c, _, across, _ in spots), default=0)
    wide = [max([0, *(len(line) for _, c, _, a, lines in spots if c == x and a == 1 for line in lines)]) for x in range(columns)]
    high = [max([0, *(len(lines) for r, _, d, _, lines in spots if r == y and d == 1)]) for y in range(n)]
    for r, c, down, across, lines in spots:
        if across > 1:
            while sum(wide[c : c + across]) + 2 * (across - 1) < max(map(len, lines)):
                wide[c + across - 1] += 1
        if down > 1:
            while sum(high[r : r + down]) < len(lines):
                high[r + down - 1] += 1
    canvas = [[" "] * (sum(wide) + 2 * columns + 200) for _ in range(sum(high))]
    for r, c, _, _, lines in spots:
        for k, line in enumerate(lines):
            for j, char in enumerate(line):
                canvas[sum(high[:r]) + k][sum(wide[:c]) + 2 * c + j] = char
    lines = ["".join(line).rstrip() for line in canvas]
    return "\n".join(lines).rstrip("\n")


def test_tables_equal_a_painted_canvas():
    rng = random.Random(5)
    for _ in range(400):
        table = [
            [
                ("\n".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(rng.choice((0, 1, 1, 1, 2, 3)))),
                 rng.choice((1, 1, 1, 2, 3)), rng.choice((1, 1, 1, 2, 0)))
                for _ in range(rng.randint(1, 4))
            ]
            for _ in range(rng.randint(1, 5))
        ]
        page = "".join(
            "<tr>" + "".join(f"<td colspan={a} rowspan={d}>{text.replace(chr(10), '<br>')}" for text, a, d in row) for row in table
        )
        expected = painted(table).lstrip("\n")
        found = text_of(f"x<table>{page}</table>")
        assert found.removeprefix("x").strip("\n") == expected, page


def test_broken_markup_never_fails():
    rng = random.Random(4)
    parts = ["<p>", "</p>", "<table>", "<tr>", "<td>", "</table>", "<ul>", "<li>", "</ul>", "x", "<", ">", "&", "<!--", "<b", "\"", "<pre>", "<ol start=-x>"]
    for _ in range(3000):
        text_of("".join(rng.choice(parts) for _ in range(rng.randint(0, 25))))
    assert text_of("<div>" * 20_000 + "x") == "x"
    for part in ("<p", "<p ", '<a "', "<!", "<!--", "<a b='", "</span>", "&", "<b><i>", "<p></b>", "<table><p>"):
        text_of("<div>" * 5000 + part * 30_000)


def test_given_pages(spark):
    rows = {r["page_id"]: r["text"] for r in op2_html_text(spark, "/root/testdata/sf0.001").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert rows == {r["page_id"]: text_of(r["html"]) for r in pages}
    for text in rows.values():
        assert "<" not in text and "track(" not in text and "margin" not in text and "©" in text


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, 2), (None, "<p>a", 2), (1, "", 2)], "page_id long, html string, text int")
    found = html_render.extract(pages).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, None), (None, "a"), (1, "")], key=repr)
    assert html_render.extract(pages.limit(0)).count() == 0
