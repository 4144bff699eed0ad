"""Page lines, alignment and neighbours."""

import random

import pytest

from clipcurate.llm import page_diff as pd_


def plain_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("seed", range(30))
def test_common_lines_are_a_longest_common_subsequence(seed):
    rnd = random.Random(seed)
    for _ in range(20):
        a, b = ([rnd.choice("xyzuv"[: rnd.randint(1, 5)]) for _ in range(rnd.randint(0, 14))] for _ in "ab")
        shared = sorted(pd_.common_lines(a, b))
        assert len(shared) == plain_length(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in shared)


def test_lines_and_markup():
    page = (
        "<html><head><title>T</title></head><body><nav><p>menu</nav><div class='cookie-notice'><div>ok</div> no</div>"
        "<main><article class=post><header><h1>Big &amp; <b>b</b>old</h1></header><p>a &lt;\n  b<br>c&nbsp;d<p>e"
        "<aside>side</aside><form>name</form><section id=comments><p>nice!</p></section></article></main>"
        "<footer>foot</footer><script>var x='</p>';</script><!-- note --></body>"
    )
    lines = pd_.lines_of(page)
    assert [t for inside, t in lines if inside] == ["Big & bold", "a < b", "c d", "e"]
    assert [t for inside, t in lines if not inside] == []
    assert pd_.lines_of("<nav>never closed<p>text") == [(False, "never closed"), (False, "text")]
    assert pd_.lines_of("") == []


def page(*lines):
    return "<body>" + "".join(f"<p>{x}</p>" for x in lines) + "</body>"


def test_extract_deletes_what_neighbours_share(spark):
    rows = [
        (1, "http://a.org/x/1", page("Menu", "one text", "Imprint")),
        (2, "http://A.org/x/2", page("Menu", "two text", "Imprint")),
        (3, "http://a.org/x/3", page("Menu", "three text", "more", "Imprint")),
        (4, "http://b.org/only", page("Menu", "alone")),
        (5, None, None),
        (6, "no url", page("Menu", "y")),
        (7, "http://c.org/1", page("the same long article", "and its end")),
        (8, "http://c.org/2", page("the same long article", "and its end")),
        (8, "http://c.org/2", page("the same long article", "and its end")),
        (9, "http://d.org/1", f"<nav>Menu</nav><article>{page('kept', 'Imprint')}</article>"),
        (10, "http://d.org/2", f"<nav>Menu</nav><article>{page('kept too', 'Imprint')}</article>"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, main_text string")
    expected = [
        (1, "one text"), (2, "two text"), (3, "three text more"), (4, "Menu alone"), (5, ""), (6, "Menu y"),
        (7, "the same long article and its end"), (8, "the same long article and its end"),
        (8, "the same long article and its end"), (9, "kept Imprint"), (10, "kept too Imprint"),
    ]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "3", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert sorted((r.page_id, r.main_text) for r in pd_.extract(pages).collect()) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert pd_.extract(pages.limit(0)).count() == 0


def test_every_page_is_aligned_and_its_markup_checks_the_difference(monkeypatch):
    menu, notice = "<nav><p>Menu<p>Home</nav>", "<div class='cookie-notice'>{}</div>"
    first = f"{menu}<article><p>quoted<p>one</article>{notice.format('own note')}<footer>Imprint</footer>"
    second = f"{menu}<article><p>quoted<p>two</article>{notice.format('other note')}<footer>Imprint</footer>"
    a, b = pd_.marked_lines(first), pd_.marked_lines(second)
    assert [t for *_, t in a] == ["Menu", "Home", "quoted", "one", "own note", "Imprint"]
    real, aligned = pd_.common_lines, []
    monkeypatch.setattr(pd_, "common_lines", lambda *sides: aligned.append(real(*sides)) or aligned[-1])
    assert pd_.main_text(a, b) == "quoted one" and aligned == [{0, 1, 2, 5}]
    # Without the names that markup gives, the difference decides alone.
    bare = [[(False, False, t) for *_, t in lines] for lines in (a, b)]
    assert pd_.main_text(*bare) == "one own note"
    assert pd_.main_text(a, None) == pd_.main_text(a, a) == "quoted one"


def test_lines_in_furniture_end_where_it_ends():
    page = "x<nav>a<script>'</nav>'</script>b<article>c</article><p>d</nav>e<aside>f<!-- </aside> -->g<form>h"
    assert [(t, out) for out, _, t in pd_.marked_lines(page)][:3] == [("x", False), ("a", True), ("'", False)]
    assert pd_.lines_of("<nav><article>c</article></nav><p>d") == [(False, "d")]
    assert pd_.lines_of("<aside>f<!-- </aside> -->g<form>h") == [(False, "-->g"), (False, "h")]
