"""Block labels where names tell nothing, odd markup, and overlaps longer than a piece."""

import time

import numpy as np
import pytest

from shiftroll.llm import decontaminate, html_blocks, queries
from tests.conftest import SMALL

# op3


@pytest.fixture(scope="module")
def pages(spark):
    return [r["html"] for r in queries.table(spark, SMALL, "pages").orderBy("page_id").collect() if r["html"]]


@pytest.fixture(scope="module")
def net(pages):
    return html_blocks.train(pages[::2])


def wrong(net, lessons):
    chances = html_blocks.labelled(net, [[x for x, _ in p] for p in lessons])
    return np.mean([int(c >= 0.5) != y for p, cs in zip(lessons, chances, strict=True) for (_, y), c in zip(p, cs, strict=True)])


def test_held_out_pages_without_names(pages, net):
    held = [[(x, html_blocks.taught(x)) for x in html_blocks.leaves(p)] for p in pages[1::2]]
    bare = [html_blocks.nameless(p) for p in held]
    assert wrong(net, held) == 0
    assert wrong(net, bare) < 0.01
    # the list of names knows no article there
    assert not any(html_blocks.taught(x) for p in bare for x, _ in p)


def test_misleading_names(net):
    made = [html_blocks.made_page(np.random.default_rng(s), True) for s in range(900, 960)]
    by_list = np.mean([html_blocks.taught(x) != y for p in made for x, y in p])
    assert wrong(net, made) < 0.05 < 0.4 < by_list


def test_slopes_of_the_labeller_are_right():
    rng = np.random.default_rng(5)
    h, n = html_blocks.HIDDEN, html_blocks.INPUTS
    net = html_blocks.Network(*[rng.normal(0, 0.3, s) for s in ((2, n, 4 * h), (2, h, 4 * h), (2, 4 * h), (2 * h,), (1,))])
    x, there, y = rng.normal(size=(4, 3, n)), np.array([[1, 1, 1]] * 3 + [[1, 0, 1]], dtype=float), rng.integers(0, 2, (4, 3))

    def loss(one):
        z = html_blocks.forward(one, x, there)[0]
        return float((there * (np.log1p(np.exp(z)) - y * z)).sum() / there.sum())

    slopes = html_blocks._slopes(net, x, there, y)
    for k, w in enumerate(net):
        at, moved = tuple(0 for _ in w.shape), []
        for step in (1e-3, -1e-3):
            other = w.copy()
            other[at] += step
            moved.append(loss(net._replace(**{net._fields[k]: other})))
        assert abs((moved[0] - moved[1]) / 2e-3 - slopes[k][at]) < 1e-3


def test_long_pages_are_scored_as_in_one_piece(net, monkeypatch):
    made = [[x for x, _ in html_blocks.made_page(np.random.default_rng(s))] for s in range(5)]
    whole = html_blocks.labelled(net, made)
    monkeypatch.setattr(html_blocks, "BLOCKS_AT_ONCE", 7)
    for a, b in zip(whole, html_blocks.labelled(net, made), strict=True):
        assert np.allclose(a, b, atol=1e-5)


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<p>One isn't <a title=it's here>link</a> two.</p>", ["One isn't link two."]),
        ("<p class=a\"b>One.<p title='a>b'>Two.", ["One.", "Two."]),
        ("<p title = \"x > y\">One.</p><!-- open > one", ["One."]),
        ("<p>1 < 2 and <b", ["1 < 2 and <b"]),
        ("<p>One.<!-- never ended", ["One."]),
    ],
)
def test_attributes_and_comments_leave_no_markup(page, texts):
    assert [x.text for x in html_blocks.leaves(page)] == texts


def test_depth_and_unended_markup_take_linear_time():
    for unit in ("<div>x", "<li>x<b>", "<p><span>x<hr>", "<svg><style>", "<a b='", "<!--", "<![", "<p "):
        took = []
        for n in (4_000, 16_000):
            start = time.process_time()
            html_blocks.leaves(unit * n)
            took.append(time.process_time() - start)
        assert took[1] < 10 * took[0] + 0.3, (unit, took)


def test_places_keep_paths():
    (leaf,) = html_blocks.leaves("<div class='Main box'><ul id=x><li><b class=y>t</b></ul></div>")
    assert leaf.path == ("div", ".main", ".box", "ul", ".x", "li")
    assert leaf.place.nameless().path() == ("div", "ul", "li")
    (deep,) = html_blocks.leaves("<nav>" * 20_000 + "t")
    assert deep.place.nameless().size == 20_000


def test_repeated_and_clashing_rows(spark, net):
    rows = [(1, "u", "<article><p>One text.</p></article>", "old", 9)] * 2 + [(1, "v", "", "old", 9)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = html_blocks.extracted(table, net)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "u", "One text.", 9)] * 2 + [(1, "v", "", 0)]


# op5


def test_long_items_are_found_whole(spark):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), 9)) for _ in range(3_000)]
    item = words[:500]
    changed = [w if k % 25 else "other" for k, w in enumerate(words[1000:2200])]
    docs = [(1, " ".join(words[2300:2400] + item + words[2400:])), (2, " ".join(words[2900:] + changed)), (3, "x " * 900)]
    bench = [(7, " ".join(item)), (8, " ".join(words[1000:2200])), (9, "one two")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["doc_at"], r["n_words"], r["n_equal"]) for r in decontaminate.overlaps(table, items).collect()}
    # the changed item begins with a changed word
    assert found == {(1, 7): (100, 500, 500), (2, 8): (101, 1199, 1152)}


def test_shorter_items_on_request(spark):
    table = spark.createDataFrame([(1, "so one two three it is"), (2, "one two")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "One, two; three!")], "item_id long, text string")
    assert decontaminate.overlaps(table, items).count() == 0
    found = decontaminate.overlaps(table, items, least_item=3).collect()
    assert [tuple(r) for r in found] == [(1, 9, 1, 3, 3)]
