"""Components without all their links, and near copies under a repeated id, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftroll.llm import jaccard_join
from tests.llm.test_corpus import components_by_hand


def by_hand(rows, words, percent):
    sets, label, _ = components_by_hand([t for _, t in rows], words, percent)
    first = {}
    for (i, _), x in zip(rows, label, strict=True):
        first[x] = min(first.get(x, i), i)
    return sorted((i, len(s), first[x]) for (i, _), s, x in zip(rows, sets, label, strict=True))


@pytest.fixture(scope="module")
def crowd():
    """Families of near copies that share their rarest words: some large, some of one, links in chains."""
    rng = np.random.default_rng(3)
    rows, start = [], "zero " * 3
    for family, copies in enumerate([40, 15, 6, 1, 1, 1, 2, 3]):
        words = [f"f{family}w{k}" for k in range(60)]
        for _ in range(copies):
            words = list(words)
            words[int(rng.integers(60))] = f"c{rng.integers(10**9)}"
            rows.append((len(rows), start + " ".join(words)))
    rows += [(len(rows) + k, rows[k][1]) for k in range(5)]
    return [rows[int(k)] for k in rng.permutation(len(rows))]


@pytest.mark.parametrize(("block", "rounds"), [(512, 4), (4, 1)])
def test_components_equal_brute_force(spark, monkeypatch, crowd, block, rounds):
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", block)
    monkeypatch.setattr(jaccard_join, "CLUSTER_ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "PAIRED_BLOCKS", 2)
    docs = spark.createDataFrame(crowd, "doc_id long, text string")
    rule = jaccard_join.Rule(3, 85)
    assert sorted(tuple(r) for r in jaccard_join.components(docs, rule).collect()) == by_hand(crowd, 3, 85)


def test_a_component_that_fills_its_blocks_is_not_paired_again(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", 8)
    monkeypatch.setattr(jaccard_join, "PAIRED_BLOCKS", 1)
    words = [f"w{k}" for k in range(400)]
    copies = [" ".join([*words[:k], f"x{k}", *words[k + 1 :]]) for k in range(0, 400, 4)]
    docs = spark.createDataFrame(list(enumerate(copies)), "doc_id long, text string")
    dealt, screened = [], jaccard_join._screened
    monkeypatch.setattr(
        jaccard_join, "_screened", lambda c, d, r: dealt.append(d.agg(F.sum(F.size("pairs"))).first()[0] or 0) or screened(c, d, r)
    )
    rule = jaccard_join.Rule(3, 90)
    got = jaccard_join.components(docs, rule).collect()
    assert {r["component_id"] for r in got} == {0}
    stars = sum(dealt)
    dealt.clear()
    jaccard_join.links_of(docs, rule).collect()
    assert stars < sum(dealt) / 2


def test_near_copies_under_a_repeated_id_go(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    near = b + " more"
    rows = [(3, b), (5, a), (5, b), (5, near), (6, a.upper()), (7, near), (None, a), (None, "alone here"), (None, "alone here")]
    rows += [(8, None), (8, ""), (8, ""), (9, "c d e f g"), (9, "C d e f g")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    got = sorted(map(repr, [tuple(r) for r in jaccard_join.first_of_each(docs).collect()]))
    assert got == sorted(map(repr, [(i, t, "s") for i, t in [(3, b), (5, a), (None, "alone here"), (8, None), (8, ""), (9, "C d e f g")]]))


def test_counted_shingles_are_shuffled_once(spark, crowd):
    rule = jaccard_join.Rule(3, 85)
    _, classes = jaccard_join.classes_of(spark.createDataFrame(crowd, "doc_id long, text string"), rule)
    prefixes = jaccard_join.prefixes_of(classes, rule)
    assert prefixes.collect()
    final = prefixes._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    by_token = [line for line in final.splitlines() if "Exchange hashpartitioning(token#" in line]
    assert "ReusedExchange" in final and len({line.split("plan_id=")[1] for line in by_token}) == 1


def test_nodes_of_many_common_hubs_are_labelled_by_few_rows(spark, monkeypatch, crowd):
    taken, components_of = [], jaccard_join.components_of

    def counted(edges, most_rounds=None):
        nodes = edges.groupBy("node").agg(F.count(F.lit(1)).alias("rows"))
        taken.append(nodes.agg(F.avg("rows")).first()[0])
        return components_of(edges, most_rounds)

    monkeypatch.setattr(jaccard_join, "components_of", counted)
    docs, rule = spark.createDataFrame(crowd, "doc_id long, text string"), jaccard_join.Rule(3, 85)
    _, classes = jaccard_join.classes_of(docs, rule)
    assert jaccard_join.units_of(docs, classes, rule).count()
    assert taken[0] < 5


def test_stars_connect_what_the_hubs_connect(spark):
    rng = np.random.default_rng(5)
    rows = sorted({(int(n), int(h)) for n, h in zip(rng.integers(0, 300, 400), rng.integers(0, 160, 400), strict=True)})
    low = {h: min(n for n, k in rows if k == h) for _, h in rows}
    edges = spark.createDataFrame([(n, h, low[h]) for n, h in rows], "node long, hub long, low long")
    wanted, got = (sorted(map(tuple, jaccard_join.components_of(e.select("node", "hub")).collect())) for e in (edges, jaccard_join.stars_of(edges)))
    assert got == wanted and 1 < len({label for _, label in got}) < len(got)
