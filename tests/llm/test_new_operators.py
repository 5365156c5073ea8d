"""Ranked search, block naming and whitening against brute force, with every odd case."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from shiftroll.llm import block_names, chat, decontaminate, jaccard_join, language, max_sketch, queries, ship, token_store, whitening
from shiftroll.session import scratch_tables
from tests.check_sql import compare, connect
from tests.conftest import SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# op11


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def searched(docs, items):
    """Scores of all pairs, by the definition."""
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, all_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        rows = []
        for i, bag in bags:
            m = 10 + 90 * sum(bag.values()) * n_docs // all_terms
            score = 0
            for t in set(terms_of(text)) & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(rows)[:10])]
    return out


ITEMS = [
    (1, "The quick brown FOX"),
    (1, "The quick brown FOX"),
    (2, "wort1 wort2 wort976 ende"),
    (None, "an item without an id, quite 1234"),
    (4, None),
    (5, ""),
    (6, " -- ?! "),
    (7, "nowhere_to_be_found"),
    (8, "lazy lazy lazy text äö id"),
]


def test_search_equals_scoring_every_pair(spark, odd, empty, rows):
    items = spark.createDataFrame([(*x, "clash", 3) for x in ITEMS], "item_id long, text string, doc_id string, score int")
    many = odd.unionByName(odd.withColumn("doc_id", F.col("doc_id") + 100))
    found = rows(max_sketch.search(many, items))
    texts = [(r["doc_id"], r["text"]) for r in many.collect()]
    assert found == sorted(searched(texts, ITEMS), key=repr)
    assert max_sketch.search(empty, items).count() == 0
    assert max_sketch.search(odd, items.limit(0)).count() == 0


def test_search_in_several_passes(spark, odd, rows, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = rows(max_sketch.search(odd, items))
    monkeypatch.setattr(max_sketch, "BLOCK_ITEMS", 2)
    assert rows(max_sketch.search(odd, items)) == expected


WORDS = st.lists(st.sampled_from("a b c d e f g h i j k l".split()), max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=6), st.lists(WORDS, min_size=1, max_size=3), st.integers(1, 4))
def test_sketches_never_bound_too_low(texts, wanted, repeats):
    data = [" ".join(t * (repeats * 100 if i == 0 else 1)).encode() for i, t in enumerate(texts) if t]
    wanted = [sorted(set(w)) for w in wanted if w]
    if not data or not wanted:
        return
    hashes, at = max_sketch.term_hashes(data)
    terms, tfs, begins = max_sketch._counted(hashes, at)
    m = np.arange(10, 10 + len(data), dtype=np.int64)
    sketches = [max_sketch.sketch_of(terms[a:b], tfs[a:b]) for a, b in zip(begins, begins[1:], strict=False)]
    queried = [max_sketch._counted(*max_sketch.term_hashes([" ".join(w).encode()]))[0] for w in wanted]
    flat = np.concatenate(queried)
    weights = np.arange(len(flat), dtype=np.int64) % 7
    starts = np.cumsum([0, *[len(q) for q in queried]])
    bounds = max_sketch._upper_bounds(sketches, m, flat, weights, starts[:-1])
    for q in range(len(queried)):
        part = slice(starts[q], starts[q + 1])
        exact = max_sketch._exact(np.arange(len(data)), terms, tfs, begins, m, flat[part], weights[part])
        assert (bounds[:, q] >= exact).all()


def test_most_documents_are_not_rescored(spark, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, SMALL, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SMALL, "benchmark").collect()]
    hashes, at = max_sketch.term_hashes([(t or "").encode() for _, t in docs])
    terms, tfs, begins = max_sketch._counted(hashes, at)
    lengths = np.diff(at)
    m = 10 + 90 * lengths * len(docs) // lengths.sum()
    sketches = [max_sketch.sketch_of(terms[a:b], tfs[a:b]) for a, b in zip(begins, begins[1:], strict=False)]
    above = 0
    for _, text in items:
        query = max_sketch._counted(*max_sketch.term_hashes([text.encode()]))[0]
        df = np.array([(terms == t).sum() for t in query])
        weights = np.array([max_sketch.weight(len(docs), int(x)) for x in df])
        bounds = max_sketch._upper_bounds(sketches, m, query, weights, np.zeros(1, dtype=np.int64))[:, 0]
        exact = max_sketch._exact(np.arange(len(docs)), terms, tfs, begins, m, query, weights)
        above += (bounds >= np.sort(exact)[-10]).sum()
    assert above < 0.5 * len(docs) * len(items)


# op12


def deduplicated(rows):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[(t or "").translate(LOWER)].append((i is not None, i or 0, k))
    out = []
    for text, members in groups.items():
        best = max(members)
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = [m for m in members if m[:2] == best[:2]]
        for m in members:
            ident = m[1] if m[0] else None
            out.append((ident, best[1] if best[0] else None, len(members), m == first[0], sha))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [5, 64])
def test_names_equal_comparing_texts(spark, odd, empty, rows, block_bytes):
    text = "aBÄ" * 40
    more = [(50 + i, text[: 60 + i % 3] + "x" * (i % 2)) for i in range(9)] + [(60, "AB"), (61, "ab"), (None, "x"), (None, "X")]
    short = odd.withColumn("text", F.substring("text", 1, 130)).select("doc_id", "text", "shard")
    extra = short.unionByName(spark.createDataFrame(more, "doc_id long, text string").withColumn("shard", F.lit("name")))
    expected = deduplicated([(r["doc_id"], r["text"]) for r in extra.collect()])
    assert rows(block_names.deduplicated(extra, block_bytes=block_bytes)) == expected
    if block_bytes == 64:
        assert block_names.deduplicated(empty).count() == 0


def test_long_texts_differ_in_their_last_byte(odd, rows):
    found = rows(block_names.deduplicated(odd), "doc_id", "group_size", "kept")
    assert (5, 1, True) in found and (6, 1, True) in found
    assert [r for r in found if r[0] in (1, 7)] == [(1, 1, True), (1, 3, False), (1, 3, False), (7, 3, True)]


def test_blocks_that_share_a_hash_keep_apart(spark, rows):
    texts = [(i, f"{i % 5:05d}" * 3 + f"{i % 3}") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    names = block_names.identities(docs, block_bytes=4, hashed=lambda b: F.octet_length(b).cast("long"))
    groups = defaultdict(set)
    for r in names.collect():
        groups[(r["level"], r["name"])].add(r["doc_id"])
    expected = defaultdict(set)
    for i, t in texts:
        expected[t].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


# op13


def vectors(spark, values):
    return spark.createDataFrame([(i, v, "clash") for i, v in values], "vec_id long, embedding array<float>, n string")


def dense(matrix):
    x = np.floor(1024 * np.asarray(matrix, dtype=np.float32).astype(float)) + 100_000
    centred = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(centred.T @ centred / len(x))
    return x, centred, values[::-1], turn[:, ::-1]


def checked(found, matrix, k):
    x, centred, values, turn = dense(matrix)
    n = len(x)
    for i in range(n):
        exact = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], x.sum(axis=0), strict=True))
        assert {r["deviation"] for r in found if r["vec_id"] == i} == {exact}
    for c in range(k):
        own = sorted((r["vec_id"], r["whitened"]) for r in found if r["component"] == c + 1)
        ours = np.array([w for _, w in own])
        theirs = centred @ turn[:, c] / np.sqrt(values[c])
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-9
        (share,) = {r["explained"] for r in found if r["component"] == c + 1}
        assert share == pytest.approx(values[c] / values.sum())
    assert all(r["identity_error"] < 1e-9 and r["n"] == n for r in found)


def test_whitening_equals_the_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    matrix = rng.standard_normal((400, 50)) * np.linspace(2, 0.5, 50) @ np.linalg.qr(rng.standard_normal((50, 50)))[0]
    found = whitening.whitened(vectors(spark, [(i, [float(v) for v in r]) for i, r in enumerate(matrix)])).collect()
    assert len(found) == 400 * 8
    checked(found, matrix, 8)


def test_odd_vectors_take_no_part(spark):
    rng = np.random.default_rng(4)
    matrix = rng.standard_normal((30, 3))
    odd = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, float("nan"), 0.0]), (94, [float("inf"), 0.0, 0.0]), (95, [1.0, 2.0])]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(matrix)]
    found = whitening.whitened(vectors(spark, rows + odd)).collect()
    assert {r["vec_id"] for r in found} == set(range(30))
    assert {r["component"] for r in found} == {1, 2, 3}
    checked(found, matrix, 3)


def test_rows_without_variance(spark):
    assert whitening.whitened(vectors(spark, [])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, None)])).count() == 0
    one = whitening.whitened(vectors(spark, [(None, [1.0, 2.0])])).collect()
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in one] == [
        (None, c, 1, 0, None, None) for c in (1, 2)
    ]
    line = whitening.whitened(vectors(spark, [(i, [float(i), float(i)]) for i in range(9)])).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)
    assert all(r["identity_error"] < 1e-9 for r in line)


def test_a_cluster_wider_than_the_block_is_exact(spark):
    axes = np.vstack([np.eye(40), -np.eye(40)])
    rows = whitening.materialise(whitening.integer_rows(vectors(spark, [(i, [float(v) for v in r]) for i, r in enumerate(axes)])))
    f = whitening.fit(rows, components=2, guard=1, degree=4)
    x = np.array([r["x"] for r in rows.collect()], dtype=float)
    v = np.cov(x.T, bias=True)
    assert np.abs(v @ f.vectors - f.vectors * f.values).max() < 1e-9 * f.values[0]
    assert f.values == pytest.approx(np.linalg.eigvalsh(v)[::-1][:2])


@pytest.mark.parametrize("name", ["op11_max_sketch", "op12_block_names"])
def test_queries_equal_their_sql(spark, name):
    assert compare(queries.registered()[name](spark, SMALL), connect(SMALL), queries.statements()[name]) == []


# earlier operators


def test_every_text_with_a_letter_gets_a_learned_language(spark, odd):
    filters = language.fit([("en", b"the cat and the dog"), ("de", b"der hund und die katze"), ("de", b"der hund und das haus")])
    names, scores, shares = language.predict(filters, ["щщщ".encode(), b"12 34", None, b"the the the", b"q", b""])
    assert names == ["de", "und", "und", "en", "de", "und"]
    assert scores[0] == shares[0] == 0 and shares[3] > 0.5
    only = language.fit([("en", b"the cat")])
    assert language.predict(only, ["щщщ".encode(), b"7"])[0] == ["en", "und"]
    assert language.predict(language.fit([]), [b"the"])[0] == ["und"]


def test_grams_of_long_texts_count_once():
    filters = language.fit([("en", b"ab cd ef")])
    text = b"ab cd " * 500_000
    data = language.prepared(text)
    total, _ = language.counts_of(filters, [text, b"ab"])
    assert total.tolist() == [2 * len(data) - 6, (4 - 2) + 0]


def test_foreign_texts_leave_the_pipeline(spark):
    rows = [(i, f"the quick brown fox and the lazy dog number {i} over the river", "en") for i in range(40)]
    rows += [(50, "щука жёлтый подъезд " * 5, None), (51, "12345", None), (52, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_share", F.lit("own"))
    kept = language.in_known_language(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(40))
    assert {r["lang_share"] for r in kept.collect()} == {"own"}


MESSAGES = "tree long, node long, parent long, role string, text string, score double"


def test_a_circle_of_replies_is_refused(spark):
    rows = [(1, 1, 2, "user", "a", 1.0), (1, 2, 1, "user", "b", 1.0), (1, 3, 2, "assistant", "c", 1.0), (2, 1, None, "user", "d", 1.0)]
    with pytest.raises(ValueError, match="tree 1"):
        chat.conversations(spark.createDataFrame(rows, MESSAGES))
    apart = chat.conversations(spark.createDataFrame(rows[:2] + rows[3:], MESSAGES))
    assert [r["tree"] for r in apart.collect()] == [2]


def test_roles_with_line_ends_come_back(spark):
    roles = ["us\ner", "a<\\nb", "\n", "\\n", "<|x\n|>"]
    rows = [(1, i + 1, i or None, role, f"t\n{i}", 1.0) for i, role in enumerate(roles)]
    found = chat.conversations(spark.createDataFrame(rows, MESSAGES)).select(chat.parsed(F.col("formatted")).alias("turns")).first()
    assert [(t["role"], t["text"]) for t in found["turns"]] == [(r, f"t\n{i}") for i, r in enumerate(roles)]


def test_long_texts_are_encoded_in_slices(monkeypatch):
    text = ("Ab cd, " * 40 + "\u00e4x" * 90 + "\n\tend ").encode()
    with open(queries.TOKENIZER, encoding="utf-8") as file:
        coder = token_store.Codec(file.read(), 1)
    whole = coder.encode([text, None, b"x"])
    monkeypatch.setattr(token_store, "SLICE_BYTES", 32)
    assert b"".join(token_store.slices_of(text)) == text
    assert coder.encode([text, None, b"x"]) == whole


def test_stages_remove_what_their_predecessors_left(spark, tmp_path):
    docs = queries.table(spark, SMALL, "documents").limit(40)
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = scratch_tables(spark)
        built = stage(spark, docs, SMALL)
        built.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(len(scratch_tables(spark) - before))
    made = corpus_pipeline._left[spark.sparkContext.applicationId]
    assert made <= scratch_tables(spark) and sizes[2] == len(made)
    assert docs.count() > 0


def test_only_sets_without_a_partner_leave_a_hub(spark):
    """Near copies of one text, each with words of its own; n counts shingles of three words."""
    rule, words = jaccard_join.Rule(3, 90), [f"w{k}" for k in range(152)]
    texts = [" ".join(f"x{c}y{k}" if k % 12 == 5 and k < 12 * c else w for k, w in enumerate(words)) for c in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, classes = jaccard_join.classes_of(docs, rule)
    met = classes.select("cls", "n").withColumn("hub", F.lit(1).cast("long"))
    thin = {r["cls"] for r in jaccard_join.without_partner(docs, classes, met, rule).collect()}
    left = sorted(r["id"] for r in classes.collect() if r["cls"] in thin)
    # a changed word changes three of 150 shingles, seven may be alone in two sets of equal size
    assert left == [3, 4, 5, 6, 7]


def test_known_pieces_are_looked_up_once():
    class Counted(dict):
        asked = 0

        def get(self, key):
            self.asked += 1
            return dict.get(self, key)

        def __getitem__(self, key):
            self.asked += 1
            return dict.__getitem__(self, key)

        def __contains__(self, key):
            self.asked += 1
            return dict.__contains__(self, key)

    with open(queries.TOKENIZER, encoding="utf-8") as file:
        coder = token_store.Codec(file.read(), 1)
    coder.known = Counted()
    long = "x" * 70 + "."
    texts = ["Words, words; and (odd) ΟΔΟΣ ΣΑΣ. İstanbul ÉÉß! a b \u0085 c1 --", "words again, \x1c and\x0bmore here", "", long, f"a {long} b"]
    plain = [coder.tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    for _ in range(2):
        assert [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode([t.encode() for t in texts])] == plain
    few = [t.encode() for t in texts[:2]] * 3
    coder.known.asked = 0
    coder.encode(few)
    assert coder.known.asked == sum(len(t.split()) for t in few)


@pytest.mark.parametrize("few", [0, 1 << 30])
def test_runs_of_pieces_are_the_tokenizers(monkeypatch, few):
    monkeypatch.setattr(token_store, "FEW_BYTES", few)
    with open(queries.TOKENIZER, encoding="utf-8") as file:
        coder = token_store.Codec(file.read(), 1)
    pieces = ["Straße,", "ÀÉÞß!", "ÿ", "a×b", "a÷b", "Å", "Ångstrom", "K", "ẞ", "don't", "dogs'", "'s", "**", "(odd)", "x2", "2", "_a_", "a b"]
    pieces += ["<|endoftext|>", "<|startoftext|>a.", "a<|endoftext|>", "ΟΔΟΣ", "好的", "\x1c", "\x00", "e" * 70 + "!", "", "Ḱ.", "µ", "ª"]
    special = coder.tokenizer.get_added_tokens_decoder().values()
    pieces += [t.content for t in special]
    rng = random.Random(7)
    texts = ["", " \n ", *pieces, *["".join(rng.choice(pieces) + rng.choice([" ", "\n", "\t ", "\r\n"]) for _ in range(40)) for _ in range(60)]]
    plain = [coder.tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    for group in (1 << 20, 100):
        monkeypatch.setattr(token_store, "GROUP_BYTES", group)
        assert [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode([t.encode() for t in texts])] == plain
    assert coder.encode([b"a \xc3 \xc3\xa9\xff b \xc3"]) == coder.encode(["a � é� b �".encode()])


def test_a_batch_asks_for_each_run_once(monkeypatch):
    class Counted(dict):
        asked = 0

        def get(self, key):
            self.asked += 1
            return dict.get(self, key)

    monkeypatch.setattr(token_store, "KEPT_RUNS", 20)
    with open(queries.TOKENIZER, encoding="utf-8") as file:
        coder = token_store.Codec(file.read(), 1)
    coder.runs = Counted()
    texts = [f"Some words, some marks; and number{k % 7} ".encode() * 20 for k in range(400)]
    few = coder.encode(texts[:7])
    coder.runs.asked = 0
    assert coder.encode(texts) == [few[k % 7] for k in range(400)]
    assert coder.runs.asked == len({b"some", b"words", b",", b"marks", b";", b"and"}) + 7
    coder.encode([" ".join(f"{'abcdefghij'[k // 10]}{'klmnopqrst'[k % 10]}" for k in range(100)).encode() * 50])
    coder.encode(texts)
    assert len(coder.runs) <= 20
    assert len(coder.known) == 0


def test_texts_go_to_python_in_batches_of_bounded_bytes(spark):
    conf = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(rows):
        for batch in rows:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    own = spark.newSession()
    ship.ship(own)
    texts = own.range(0, 4000, 1, 1).selectExpr("repeat('abcdefghij', 300) AS text")
    found = [r["bytes"] for r in texts.mapInArrow(sizes, "bytes long").collect()]
    assert sum(found) > 12_000_000 and max(found) < (4 << 20) + 10_000
    own.conf.set(conf, "1m")
    ship.ship(own)
    assert own.conf.get(conf) == "1m"


def _texts_of_columns(names):
    kinds = {"text": pa.string(), "s1": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([], kinds.get(n, pa.int64())) for n in names], names=names)


@pytest.mark.parametrize(
    "run, columns",
    [
        (lambda: jaccard_join._sets(jaccard_join.Rule()), ["doc_id", "text"]),
        (lambda: jaccard_join._whole_sets(jaccard_join.Rule()), ["cls", "s1", "text"]),
        (lambda: jaccard_join._screen(jaccard_join.Rule()), None),
        (lambda: jaccard_join._verify(jaccard_join.Rule()), None),
        (lambda: decontaminate._item_words, ["item_id", "text"]),
        (lambda: token_store._documents(b""), ["start", "content"]),
    ],
)
def test_a_worker_drops_the_tokenizer_for_other_operators(run, columns):
    with open(queries.TOKENIZER, encoding="utf-8") as file:
        content = file.read()
    token_store.codec(content, 1)
    batches = [_texts_of_columns(columns)] if columns else []
    assert list(run()(iter(batches))) == []
    assert token_store.codec.cache_info().currsize == 0
    kept = token_store.codec(content, 1)
    sent = type("Sent", (), {"value": content})
    assert list(token_store._frames(sent, 1, b"")(iter([]))) == []
    assert token_store.codec(content, 1) is kept


def test_a_worker_gives_memory_back_after_a_task(spark):
    rule = jaccard_join.Rule()

    def private():
        with open("/proc/self/smaps_rollup") as file:
            return int(re.search(r"\nPss_Anon:\s+(\d+)", file.read())[1]) >> 10

    def run(rows):
        for batch in rows:
            held = [np.ones(60_000, np.uint8) for _ in range(4000)]  # too small for pages of their own
            last = np.ones(60_000, np.uint8)  # ends the heap
            before = private()
            del held
            assert list(jaccard_join._sets(rule)(iter([]))) == []
            yield pa.RecordBatch.from_pydict({"before": [before], "after": [private()], "last": [int(last[0])]})

    found = spark.range(0, 1, 1, 1).mapInArrow(run, "before long, after long, last long").first()
    assert found["before"] - found["after"] > 200
