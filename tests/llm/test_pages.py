import random

from slotcast.llm import pages


def longest(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            rows[i + 1][j + 1] = rows[i][j] + 1 if a[i] == b[j] else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def test_common_lines_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(2000):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(12))] for _ in range(2))
        marked = pages.common_lines(a, b)
        assert sum(marked) == longest(a, b)
        left = iter(b)
        assert all(any(x == y for y in left) for x in [x for x, m in zip(a, marked) if m])


def page(body: str, n: int) -> str:
    return (
        f"<html><head><title>t{n}</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><a href='/'>Home</a></nav>"
        f"<div class='ad'>Buy {n}</div>{body}<aside>Popular</aside><form>Name<input></form><div id='comments'><p>I disagree {n}</p></div><footer>&copy; site</footer></body></html>"
    )


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, host int").repartition(2)


def texts(spark, rows):
    got = {r["page_id"]: r for r in pages.extract(table(spark, rows)).collect()}
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got.values())
    return {i: r["text"] for i, r in got.items()}


def test_article_alone_stays(spark):
    rows = [(i, f"http://a.org/p/{i}", page(f"<article><h1>Title &amp; {i}</h1><p>One  two\n three {i}<br>four<p>five</article>", i)) for i in range(6)]
    assert texts(spark, rows) == {i: f"Title & {i}\nOne two three {i}\nfour\nfive" for i in range(6)}


def test_lines_shared_with_neighbours_are_deleted_outside_articles(spark):
    body = "<div><p>Our site since 1999</p></div><div><p>Story {0} begins here</p><p>and ends {0}</p><p>third of {0}</p></div><div><p>All rights kept</p></div>"
    rows = [(i, f"http://b.org/{i}", page(body.format(i), i)) for i in range(8)]
    assert texts(spark, rows) == {i: f"Story {i} begins here\nand ends {i}\nthird of {i}" for i in range(8)}


def test_copies_keep_their_lines_and_broken_pages_are_read(spark):
    body = "<div><p>Same words</p><p>in both copies</p></div>"
    rows = [(0, "http://c.org/a", body), (1, "http://c.org/a?x", body), (2, None, None), (3, "nonsense", ""), (4, "http://d.org", "<article><p>cut &amp; of"), (5, "http://e.org", "<p>1 < 2 <b title='x>y'>bold</b> <p")]
    assert texts(spark, rows) == {0: "Same words\nin both copies", 1: "Same words\nin both copies", 2: "", 3: "", 4: "cut & of", 5: "1 < 2 bold"}


def test_empty_table(spark):
    assert pages.extract(table(spark, [(1, "http://a", "x")]).limit(0)).count() == 0


def test_long_page(spark):
    body = "<article>" + "".join(f"<p>line {i}</p>" for i in range(20_000)) + "</article>"
    assert texts(spark, [(1, "http://a.org/1", body)])[1].count("\n") == 19_999


def test_attributes_without_quotes(spark):
    rows = [(1, "http://a.org/1", "<article><p title=it's>First <a href=/x?y='>link</a></p><p data-a = 'b>c' title=\"d>e\" hidden>second</p></article>")]
    assert texts(spark, rows) == {1: "First link\nsecond"}


def test_copies_take_no_table_of_lines():
    lines = [f"line {i}" for i in range(30_000)]
    assert all(pages.common_lines(lines, list(lines)))
    assert sum(pages.common_lines(lines, lines[:9] + ["x"] + lines[10:])) == 29_999
