"""The corpus operators against brute force, on small tables with every odd case."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftroll.llm import chat, decontaminate, html_blocks, jaccard_join, language, mixing, quality, queries, sharding, token_store, toxicity
from shiftroll.llm.words import word_hashes
from tests.check_sql import compare, connect
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return queries.table(spark, SMALL, "documents")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text()), max_size=8))
def test_words_are_those_of_the_pattern(texts):
    hashes, at = word_hashes([t.encode() if t is not None else None for t in texts])
    words = [WORD.findall(t or "") for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len(set(flat)) == len(set(hashes.tolist()))
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat))


# op1


def dealt_one_by_one(nodes, keys, bounds):
    """Rows go round by round to their next node with room, in ring order."""
    room, out = list(bounds), {}
    pending = []
    for k in sorted(keys):
        place = next((i for i, (b, _) in enumerate(nodes) if b >= k[0]), 0)
        pending.append((k, place))
    while pending:
        left = []
        for k, i in pending:
            if room[nodes[i][1]]:
                room[nodes[i][1]] -= 1
                out[k] = nodes[i][1]
            else:
                left.append((k, i))
        pending = [(k, next((i + s) % len(nodes) for s in range(1, len(nodes) + 1) if room[nodes[(i + s) % len(nodes)][1]])) for k, i in left]
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=60), st.integers(1, 5))
def test_ring_walk_equals_dealing_row_by_row(bins, shards):
    nodes = sorted((b * 7 % 31, s) for s in range(shards) for b in range(s, 31, shards + 2))
    bounds = sharding.bounds_of(len(bins), shards)
    keys = [(b, i) for i, b in enumerate(bins)]
    found = {}
    for b, first, end, shard, _ in sharding.walk(nodes, dict(Counter(bins)), bounds):
        for k in sorted(k for k in keys if k[0] == b)[first:end]:
            found[k] = shard
    assert found == dealt_one_by_one(nodes, keys, bounds)


def test_shards_are_even_and_slots_gapless(docs, odd, empty):
    for table, n in ((docs, docs.count()), (odd, 11)):
        rows = sharding.shard_documents(table, 7).collect()
        assert len(rows) == n
        counts = Counter(r["shard"] for r in rows)
        assert max(counts.values()) - min(counts[s] for s in range(7)) <= 1
        assert {(r["shard"], r["slot"]) for r in rows} == {(s, i) for s in counts for i in range(counts[s])}
    assert sharding.shard_documents(empty, 7).count() == 0


# op2


def base_by_hand(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_quality_rules_and_model(spark, docs, odd, empty):
    labels = queries.table(spark, SMALL, "labels")
    model = quality.learned(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = quality.judged(docs, model).collect()
    for r in rows:
        n = base_by_hand(texts[r["doc_id"]])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == n
        assert r["base_failed"] == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert not (r["base_failed"] and r["kept"])
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    judged = [(r["kept"], known[r["doc_id"]]) for r in rows if r["doc_id"] in known and not r["base_failed"]]
    assert np.mean([kept == bool(label) for kept, label in judged]) > 0.9
    assert quality.judged(odd, model).count() == 11
    assert quality.judged(empty, quality.learned(empty, labels)).count() == 0


# op3


def test_main_text_of_pages(spark):
    page = (
        "<body><nav><ul><li><a href=/>Home</a></ul></nav><div class='cookie-notice'>Cookies!</div><article><h1>A &amp; B</h1>"
        "<p>One <b>bo</b>ld\n  text.<p>Two<br>lines.<aside>Advert</aside></article><section class=comments><p>No!</p></section><footer>c</footer>"
    )
    pages = queries.table(spark, SMALL, "pages")
    odd = spark.createDataFrame([(1, "u", page, 0), (2, None, None, 1), (None, "v", "", 2)], "page_id long, url string, html string, n_chars long")
    net = html_blocks.learned(pages)
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_blocks.extracted(odd, net).collect()}
    assert got == {1: ("A & B One bold text. Two lines.", 31), 2: ("", 0), None: ("", 0)}
    made = [html_blocks.made_page(np.random.default_rng(s)) for s in range(900, 960)]
    chances = html_blocks.labelled(net, [[x for x, _ in p] for p in made])
    right = [int(c >= 0.5) == y for p, cs in zip(made, chances, strict=True) for (_, y), c in zip(p, cs.tolist(), strict=True)]
    assert np.mean(right) > 0.95


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ('<header><svg class="i"/></header><p>One.</p><p>Two.</p>', ["One.", "Two."]),
        ("<p>One <svg viewBox='0 0 1 1' /> two.</p><p>x</p><svg><path d='M0'/></svg>", ["One two.", "x"]),
        ("<header><svg><path d='M0'></header><p>One.</p>", ["One."]),
        ("<div><svg><g><p>One.</p></div><article><p>Two.</p></article>", ["One.", "Two."]),
        ("<p>Icon <svg><title>hidden</title><style>p{}</style><g></g></svg> here.</p>", ["Icon here."]),
        ("<svg><title/></svg><p>One.</p><svg><title>a</svg><p>Two.</p><svg><title>b</title></svg>", ["One.", "Two."]),
        ("<p>As <math><mi>a</mi><mo>+</mo><mi>b</mi></math> shows.</p><p>x</p>", ["As a+b shows.", "x"]),
        ("<p>As <math/> shows.</p><math><mi>c<p>x</p>", ["As shows.", "c", "x"]),
        ("<div><object data='a'><p>Other text.</p></object> after</div>", ["Other text.", "after"]),
        ("<div><object data='a'/>One.</div><div><object>Two.</div><p>Three.</p>", ["One.", "Two.", "Three."]),
        ("<button><svg><g>go</button>One.<script>a<b</script><p>Two.</p>", ["go", "One.", "Two."]),
    ],
)
def test_blocks_around_embedded_elements(page, texts):
    assert [x.text for x in html_blocks.leaves(page)] == texts
    assert all(x.path == tuple(y for y in x.path if y not in ("svg", "math", "object", "g", "mi")) for x in html_blocks.leaves(page))


# op4


def components_by_hand(texts, words, percent):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    label = list(range(len(sets)))
    links = Counter()
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    return sets, label, links


@pytest.mark.parametrize(("words", "percent", "block", "rounds"), [(3, 90, 512, 4), (5, 80, 4, 1)])
def test_near_duplicates_equal_brute_force(spark, docs, monkeypatch, words, percent, block, rounds):
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", block)
    monkeypatch.setattr(jaccard_join, "CLUSTER_ROUNDS", rounds)  # 1: clusters are left to their hubs
    rows = docs.orderBy("doc_id").collect()
    sets, label, links = components_by_hand([r["text"] for r in rows], words, percent)
    first = {}
    for r, x in zip(rows, label, strict=True):
        first[x] = min(first.get(x, r["doc_id"]), r["doc_id"])
    wanted = sorted((r["doc_id"], len(s), first[x], links[i]) for i, (r, s, x) in enumerate(zip(rows, sets, label, strict=True)))
    assert sorted(tuple(r) for r in jaccard_join.links_of(docs, jaccard_join.Rule(words, percent)).collect()) == wanted


def test_screening_loses_no_link():
    rng = np.random.default_rng(5)
    rule = jaccard_join.Rule(3, 90)
    limit = np.uint64(rule.counted_below())
    base = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[k % 5 :], rng.integers(0, 1 << 64, k % 9, dtype=np.uint64)])) for k in range(60)]
    sets += [np.unique(rng.integers(0, 1 << 64, 1 + k, dtype=np.uint64)) for k in range(60)]
    sizes = np.array([len(s) for s in sets])
    passed = {tuple(p) for p in jaccard_join.may_link(sizes, [s[s < limit] for s in sets], rule).tolist()}
    pairs = {(i, j) for j in range(len(sets)) for i in range(j)}
    common = {p: len(np.intersect1d(sets[p[0]], sets[p[1]])) for p in pairs}
    linked = {p for p in pairs if 100 * common[p] >= 90 * (sizes[p[0]] + sizes[p[1]] - common[p])}
    assert linked <= passed < pairs


def test_near_duplicates_of_odd_rows(odd, empty):
    got = sorted(map(repr, jaccard_join.links_of(odd, jaccard_join.Rule(3, 90)).select("doc_id", "component_id", "n_links").collect()))
    wanted = [(1, 1, 2), (1, 1, 2), (1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (None, None, 0), (5, 5, 1), (6, 5, 1), (7, 1, 2), (8, 8, 0)]
    assert got == sorted(f"Row(doc_id={a}, component_id={b}, n_links={c})" for a, b, c in wanted)
    kept = jaccard_join.first_of_each(odd, jaccard_join.Rule(3, 90))
    assert kept.columns == odd.columns and kept.count() == 8
    assert jaccard_join.links_of(empty).count() == 0


# op5


def test_overlaps_tolerate_substitutions(spark, odd, empty):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 7))
    items = [[word() for _ in range(n)] for n in (30, 16, 7, 3)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(9, None), (None, "")], "item_id long, text string")
    noise = lambda n: [word() for _ in range(n)]
    changed = [w if k % 8 != 5 else "other" for k, w in enumerate(items[0])]
    texts = [noise(300) + items[0] + noise(300), noise(40) + changed, [w.upper() + "," for w in items[1]], noise(9) + items[2] + noise(9), noise(50) + items[3], items[0][:6] + noise(60)]
    table = spark.createDataFrame([(i, " ".join(t), 0) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(table, bench).collect()) == [(0, 0), (1, 0), (2, 1), (3, 2)]
    assert sorted(r["doc_id"] for r in decontaminate.without_benchmark(table, bench).collect()) == [4, 5]
    assert decontaminate.without_benchmark(odd, bench).count() == 11
    assert decontaminate.overlaps(empty, bench).count() == 0


def test_overlaps_tolerate_substitutions_near_the_ends():
    item = np.arange(15, dtype=np.int64)
    for changed in ([1, 13], [1], [13], [1, 7, 13], [2, 12]):
        text = np.concatenate([np.arange(100, 120), np.where(np.isin(item, changed), -1, item), np.arange(200, 220)])
        at, n, equal = decontaminate.overlap(text, item, 20)
        assert at >= 20 and n >= 12 and equal >= 0.75 * n
    # the longer of two segments that score the same
    copied = np.where(np.arange(18) == 15, -1, np.arange(18))
    assert decontaminate.overlap(copied, np.arange(18), 0) == (0, 18, 17)
    assert decontaminate.overlap(np.where(item < 8, item, -1), item, 0) is None


@settings(max_examples=100, deadline=None)
@given(st.lists(st.booleans(), min_size=5, max_size=40))
def test_overlaps_are_found_where_any_segment_qualifies(equal):
    item = np.arange(len(equal), dtype=np.int64)
    least = min(12, len(equal))
    segments = [equal[a:b] for a in range(len(equal)) for b in range(a + least, len(equal) + 1)]
    found = decontaminate.overlap(np.where(equal, item, -1), item, 0)
    assert (found is not None) == any(sum(x) >= 0.75 * len(x) for x in segments)


def test_overlaps_with_items_of_no_id_and_of_one_id(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), 7)) for _ in range(20)) for _ in range(5)]
    ids = [None, None, 1, 1, 1]
    bench = spark.createDataFrame([*zip(ids, texts, strict=True), (1, texts[2])], "item_id long, text string")
    docs = spark.createDataFrame([*enumerate(texts), (5, f"{texts[3]} {texts[4]}")], "doc_id long, text string")
    found = decontaminate.overlaps(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["n_equal"]) for r in found) == [(i, k, 20) for i, k in enumerate([*ids, 1])]
    assert decontaminate.without_benchmark(docs, bench).count() == 0


# op6


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="\\<|im_end>a\n", max_size=20))
def test_escaping_has_one_way_back(text):
    escaped = text.replace("\\", "\\\\").replace("<|", "<\\|")
    assert "<|" not in escaped
    assert escaped.replace("<\\|", "<|").replace("\\\\", "\\") == text


def test_chat_equals_sql(spark):
    assert compare(queries.registered()["op6_chat"](spark, SMALL), connect(SMALL), queries.statements()["op6_chat"]) == []


def test_branches_are_ranked_paths(spark):
    tree = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "x", 1.0), (1, 3, 1, "assistant", "y", 5.0), (1, 4, 2, "user", None, 9.0), (2, 1, None, None, "<|im_end|>", None)]
    rows = spark.createDataFrame(tree, "tree long, node long, parent long, role string, text string, score double")
    got = chat.conversations(rows).withColumn("turns", chat.parsed(chat.F.col("formatted"))).orderBy("tree", "rank").collect()
    assert [(r["tree"], r["rank"], r["score"], [tuple(t) for t in r["turns"]]) for r in got] == [
        (1, 1, 10.0, [("user", "q"), ("assistant", "x"), ("user", "")]),
        (1, 2, 5.0, [("user", "q"), ("assistant", "y")]),
        (2, 1, 0.0, [("", "<|im_end|>")]),
    ]
    assert chat.conversations(rows, 1).count() == 2
    assert chat.conversations(rows.limit(0)).count() == 0


# op7


def test_slopes_of_the_network_are_right():
    rng = np.random.default_rng(5)
    shapes = [(2, 4, 24), (2, 8, 24), (2, 24), (16,), (16,), (1,)]
    net = toxicity.Network(*[rng.normal(0, 0.4, s) for s in shapes])
    x, there = rng.normal(size=(5, 3, 4)), np.array([[1, 1, 1]] * 3 + [[1, 0, 1]] * 2, dtype=float)
    y, balance = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss(n):
        z = toxicity.forward(n, x, there)[0]
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    slopes = toxicity._slopes(net, x, there, y, balance)
    for k, w in enumerate(net):
        at = tuple(0 for _ in w.shape)
        moved = [a.copy() for a in net]
        moved[k][at] += 1e-3
        assert (loss(toxicity.Network(*moved)) - loss(net)) / 1e-3 == pytest.approx(slopes[k][at], abs=2e-3)


def test_toxicity_finds_planted_words(odd, empty):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    rows = []
    for i in range(400):
        words = [word() for _ in range(int(rng.integers(20, 200)))]
        if i % 4 == 0:
            words[:: max(1, len(words) // 4)] = ["vile"] * len(words[:: max(1, len(words) // 4)])
        rows.append((" ".join(words).encode(), int(i % 4 == 0)))
    model = toxicity.train(rows)
    found = toxicity.scores_of(model, [t for t, _ in rows] + [None, b"", b" ."])
    assert np.mean((found[:400] >= 0.5) == [y for _, y in rows]) > 0.97
    assert found[400:].tolist() == [0, 0, 0]
    assert toxicity.scored(odd, model).count() == 11 and toxicity.scored(empty, model).count() == 0


def test_toxicity_scores_do_not_depend_on_the_share_drawn(spark):
    rng = np.random.default_rng(9)
    texts = [" ".join("".join(w) for w in rng.choice(list("abcdefghij"), (30, 6))) for _ in range(2400)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    # labels that the texts do not tell: a tenth is toxic, drawn as one half
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(2400)], "doc_id long, toxic int")
    model = toxicity.learned(docs, labels, 150)
    scores = toxicity.scores_of(model, [t.encode() for t in texts[:600]])
    assert 0.03 < scores.mean() < 0.25 and np.mean(scores >= 0.5) < 0.03


# op8


def test_mix_meets_its_targets(docs, odd, empty):
    rows = mixing.mix(docs).collect()
    per = Counter()
    for r in rows:
        per[r["source"]] += r["taken"]
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    target = {r["source"]: r["target"] for r in rows}
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in rows))
    for source, t in target.items():
        assert abs(per[source] - t) <= max(r["size"] for r in rows if r["source"] == source)
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(odd).count() == 11 and mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mixed_documents(empty).count() == 0


def test_exchange_keeps_words_and_expectation():
    size, share = np.array([9.0, 5.0, 4.0, 2.0, 1.0]), np.array([0.3, 0.6, 0.5, 0.9, 0.2])
    rng = np.random.default_rng(1)
    total = np.zeros(5)
    for _ in range(4000):
        out, held = mixing.pivot(size, share, rng.random(5))
        assert (out * size).sum() == pytest.approx((share * size).sum())
        assert all(v in (0.0, 1.0) for k, v in enumerate(out) if k != held)
        total += out
    assert np.abs(total / 4000 - share).max() < 0.04


# op9


def test_language_of_held_out_documents(docs, odd, empty):
    filters = language.learned(docs.filter(~language.is_held_out("doc_id")))
    rows = language.identify(docs.filter(language.is_held_out("doc_id")), filters).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(odd, filters).collect()}
    assert got[2] == got[3] == got[4] == got[8] == "und" and got[1] == "en"
    assert language.identify(odd, language.learned(empty)).filter("lang_pred != 'und'").count() == 0


# op10


def test_ids_are_those_of_the_library(spark, docs, odd, empty, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    for n, table in enumerate((docs.select("doc_id", "text"), odd)):
        store = token_store.write(table, str(tmp_path / str(n)), queries.TOKENIZER, 1)
        got = sorted((tuple(r) for r in token_store.digest(spark, store).collect()), key=lambda r: r[1])
        ids = {(r["doc_id"], tuple(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + (1,)) for r in table.collect()}
        wanted = Counter((d, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for d, x in ids)
        assert {(d, n, c) for d, _, n, c in got} == set(wanted)
        assert [g[1] for g in got] == [sum(x[2] for x in got[:k]) for k in range(len(got))]
        assert [g[0] or -1 for g in got] == sorted(g[0] or -1 for g in got)
    assert [x.tolist() for x in token_store.document(spark, store, 3)] == [[1]]
    assert token_store.encoded(empty, queries.TOKENIZER).count() == 0
    block = bytes(store.blocks(spark).first()["content"])
    with pytest.raises(ValueError, match="another dictionary"):
        token_store.Block(block, b"x")


def test_odd_pieces_are_encoded_alike():
    from tokenizers import Tokenizer

    with open(queries.TOKENIZER, encoding="utf-8") as file:
        coder = token_store.Codec(file.read(), 1)
    text = "Don't it's <|endoftext|>x \u0130x \u00c9T\u00c9!! e\u0301 \u0301 a\u00a0b \u03a3\u03a3 \x1c 12ab a_b 's \u00df\u1e9e " + "z" * 500
    wanted = Tokenizer.from_file(queries.TOKENIZER).encode(text, add_special_tokens=False).ids + [1]
    assert np.frombuffer(coder.encode([text.encode()])[0], coder.dtype).tolist() == wanted


# pipeline


def test_pipeline_stages_keep_columns_and_clean_documents(spark, docs):
    import corpus_pipeline

    columns = docs.columns
    table = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, table, SMALL)
        assert after.columns == columns
        assert after.count() > 0.7 * table.count(), name
        table = spark.createDataFrame(after.collect(), docs.schema)
    assert corpus_pipeline.STAGES[3][1](spark, table, SMALL).columns == columns
