from __future__ import annotations

import random

from wattloom.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Head&nbsp;line &amp; more</h1><p><b>First <i>para</i>graph.<br>still
first<p>Second &lt;one&gt; &#233;<div class="ad-box">Buy</div><aside>Side</aside><blockquote>Quote</blockquote>
<form><input><button>Send</button></form><section id="comments"><p>Reader says</p></section></article><footer>End</footer></body></html>"""


def test_marked_article():
    kinds, _, texts = zip(*pages.lines_of(PAGE), strict=True)
    assert pages.main_text(list(kinds), list(texts), [False] * len(texts)) == "Head line & more\nFirst paragraph. still first\nSecond <one> é\nQuote"


def test_deep_and_unclosed_markup_takes_linear_time_and_memory():
    import time
    import tracemalloc

    for page in ("<b>x<p>y" * 130_000, "<div>" * 200_000 + "z", "<p title='>a<i>b</i>" * 50_001, "</b><div>t" * 100_000, "<p title=\"'>a" + "<b c=\">d<i e='>" * 60_001):
        start = time.perf_counter()
        tracemalloc.start()
        found = pages.lines_of(page)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 200 << 20 and time.perf_counter() - start < 30
        assert found
    lines = pages.lines_of("<b>x<p>y" * 1000)
    assert [t for _, _, t in lines] == ["x"] + ["yx"] * 999 + ["y"] and len({place for _, place, _ in lines}) == 1001


def test_places_are_those_of_the_open_elements():
    page = "<div><p>a</p><p>b</p><div><p>c</p></div></div><div><p>d</p></div>"
    a, b, c, d = (place for _, place, _ in pages.lines_of(page))
    assert a == b == d and a != c


def test_longest_common_lines():
    draw = random.Random(6)
    for _ in range(2000):
        k = draw.choice([2, 5, 20])
        a, b = ([draw.randint(0, k) for _ in range(draw.randint(0, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        mine = [x for x, shared in zip(a, pages.common_lines(a, b), strict=True) if shared]
        rest = iter(b)
        assert len(mine) == best[-1][-1] and all(x in rest for x in mine)


def _soup(words, own):
    return "<div><div>Our site</div><div>" + "</div><div>".join(words) + f"</div><div>{own}</div><div>All rights reserved</div></div>"


def test_unmarked_pages_lose_what_neighbours_share(spark):
    rows = [(i, f"http://h.example/x/{i}", _soup(["Latest", "Contact"], f"Story number {i} <a href=q>link</a> text.")) for i in range(4)]
    rows += [(9, "http://other.example/1", _soup(["Only"], "here"))]
    out = {r["page_id"]: r for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [out[i]["text"] for i in range(4)] == [f"Story number {i} link text." for i in range(4)]
    assert out[9]["text"] == "Our site\nOnly\nhere\nAll rights reserved"
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())


def test_copies_and_shared_articles_stay_whole(spark):
    article = "<article><p>Same licence line.</p><p>{}</p></article><footer>foot</footer>"
    rows = [(i, f"http://h.example/{i}", article.format("one text")) for i in range(3)] + [(7, "http://h.example/7", article.format("other"))]
    out = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {**dict.fromkeys(range(3), "Same licence line.\none text"), 7: "Same licence line.\nother"}


def test_marked_pages_are_differenced(spark):
    page = "<div>Our site</div><article><p>Same licence line.</p><p>Story {0}</p></article><div>Note on story {0}</div><div class=ad>Buy {0}</div>{1}<div>All rights reserved</div>"
    rows = [(i, f"http://h.example/{i}", page.format(i, "<p class=notice>once</p>" if i == 2 else "")) for i in range(4)] * 2
    rows += [(9, "http://alone.example/9", page.format(9, ""))]
    out = sorted((r["page_id"], r["text"]) for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    expected = [(i, f"Same licence line.\nStory {i}\nNote on story {i}") for i in range(4)] * 2
    assert out == sorted([*expected, (9, "Same licence line.\nStory 9")])


def test_marks_correct_differencing_only():
    kinds, texts = [pages.PLAIN, pages.ARTICLE, pages.ARTICLE, pages.MAIN, pages.FURNITURE, pages.LINKS, pages.PLAIN], list("abcdefg")
    assert pages.main_text(kinds, texts, [True, True, False, False, False, False, False]) == "b\nc\nd\ng"
    assert pages.main_text(kinds, texts, [False, True, True, True, True, True, True]) == "a\nb\nc"
    assert pages.main_text(kinds, texts, None) == "b\nc"
    assert pages.main_text([0, 4, 1, 0], list("abcd"), None) == "a\nd"


def test_runs_of_copies_are_differenced(spark):
    same = _soup(["Latest"], "One story")
    rows = [(i, f"http://h.example/x/{i}", same) for i in range(3)] + [(3, "http://h.example/x/3", _soup(["Latest"], "Other story"))]
    rows += [(i, f"http://i.example/x/{i}", same) for i in range(10, 13)]
    out = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [out[i] for i in range(4)] == ["One story"] * 3 + ["Other story"]
    assert [out[i] for i in range(10, 13)] == ["Our site\nLatest\nOne story\nAll rights reserved"] * 3


def test_neighbours_across_parts():
    draw = random.Random(3)
    for _ in range(500):
        rows = sorted((draw.choice("ab"), draw.choice("xyz") * draw.randint(0, 3), draw.randint(0, draw.choice([0, 1, 3])), i) for i in range(draw.randint(1, 14)))
        whole = {r[3]: (b, a) for start, end, b, a in pages.runs_of(rows) for r in rows[start:end]}
        cuts = sorted({0, len(rows), *(draw.randint(0, len(rows)) for _ in range(draw.randint(0, 6)))})
        found, edges = {}, {}
        for part, (at, to) in enumerate(zip(cuts, cuts[1:], strict=False)):
            runs = pages.runs_of(rows[at:to])
            found |= {r[3]: (part, nth == 0, nth + 1 == len(runs), b, a) for nth, (start, end, b, a) in enumerate(runs) for r in rows[at:to][start:end]}
            edges[part] = (rows[at], rows[to - 1], len(runs) == 1, runs[-1][2], runs[0][3])
        far = {part: ((b, b_near), (a, a_near)) for part, b, b_near, a, a_near in pages.across(edges)}
        assert whole == {i: (far[p][0] if first else b, far[p][1] if last else a) for i, (p, first, last, b, a) in found.items()}


def test_siblings_of_a_large_host_meet(spark):
    rows = [(100 * s + i, f"http://h.example/s{s:03d}/{i:02d}", _soup([f"Menu of section {s}", f"Teaser {s}"], f"Story {s} {i}")) for s in range(200) for i in range(6)]
    random.Random(2).shuffle(rows)
    out = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {100 * s + i: f"Story {s} {i}" for s in range(200) for i in range(6)}


def test_large_hosts_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(pages, "GROUP_PAGES", 8)
    rows = [(i, f"http://h.example/{i}", _soup(["Latest"], f"Story {i}")) for i in range(100)]
    out = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {i: f"Story {i}" for i in range(100)}


def test_parts_give_what_the_whole_order_gives(spark, monkeypatch):
    monkeypatch.setattr(pages, "GROUP_PAGES", 3)
    draw = random.Random(8)
    mark = ["<div>{}</div>", "<article><p>{}</p></article>", "<div class=ad>{}</div>", "<p>{}</p>"]
    rows = []
    for i in range(150):
        html = "".join(draw.choice(mark).format(draw.choice("abcd")) for _ in range(draw.randint(0, 4)))
        rows += [(draw.choice([None, i, i // 9]), f"http://{draw.choice('hi')}.example/{draw.choice('xy') * draw.randint(0, 3)}", html)] * draw.choice([1, 1, 1, 2, 12])
    read = []
    for number, url, html in rows:
        lines = pages.lines_of(html)
        read.append((url[7], url.split("example")[1], number is not None, number or 0, pages._keys_of(lines), lines))
    read.sort(key=lambda r: (r[:4], r[4][1]))
    ordered = [(r[0], r[1], r[4][1], i) for i, r in enumerate(read)]
    expected = []
    for start, end, before, after in pages.runs_of(ordered):
        other = (after if after[1] > before[1] else before)[0]
        for host, _, known, number, (keys, _), lines in read[start:end]:
            shared = None if other is None else pages.common_lines(keys, read[other][4][0])
            text = pages.main_text([k for k, _, _ in lines], [t for _, _, t in lines], shared)
            expected.append((host, number if known else -1, text))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = [(r["url"][7], -1 if r["page_id"] is None else r["page_id"], r["text"]) for r in pages.extract(frame).collect()]
    assert sorted(out) == sorted(expected)


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "plain text only"), (4, "http://x/a", "<p>cut off <b"), (None, "http://x/b", "<p>no id</p>"), (6, "http://x/c", "<" * 50), (7, "http://x/d", "<p>" + "long " * 100_000), (7, "http://x/d", "<p>" + "long " * 100_000), (8, "http://x/e", "a < b <p class='x>y</p> z")]
    frame = spark.createDataFrame([(*r, "clash", 5) for r in rows], "page_id long, url string, html string, host string, keys int")
    out = pages.extract(frame).collect()
    assert len(out) == len(rows) and all(r["text"] is not None and r["n_chars"] == len(r["text"]) for r in out)
    by_id = {r["page_id"]: r["text"] for r in out}
    assert by_id[1] == by_id[2] == "" and by_id[3] == "plain text only" and by_id[None] == "no id" and by_id[7] == " ".join(["long"] * 100_000)
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
