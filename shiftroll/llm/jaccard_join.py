"""Near duplicates by a grouped prefix join on word shingles.

Two documents link when their sets of shingles have at least a given Jaccard
similarity.  Documents with equal sets are one class from the start.  For the
rest a prefix filter finds candidates: of two linked sets with at least a
share t in common, the first n - ceil(t n) + 1 members in any order that is
the same for all must meet.  The order used here puts rare shingles first:

1. the *counted* shingles, whose hash falls in a fixed part of the hash range,
   by their number of classes, so only that part is counted and shuffled;
2. all others by hash.

Counted shingles of one class alone need no table: they come first and meet
nothing.  A document whose prefix is full of them has no near duplicate.

Documents with equal size and equal prefix form one group.  A hub is a prefix
shingle together with a band of sizes, so that only groups whose sizes allow a
link meet in one.  Groups that share hubs, directly or through others, form a
cluster, found by label propagation over (group, hub) rows, which are never
paired; a chain that has not settled after a few rounds is left to its hubs.  The members of a unit, which is a cluster, or each hub of a long
chain of groups, first come together with their counted shingles.  These are
all of a set's members in one part of the hash range, so the common ones are
known exactly there, and outside of it at most all others can be common; pairs
that cannot reach the least overlap even so are out.

Before that, the members of hubs of more than BLOCK_MEMBERS members count all
their shingles among themselves.  What one set alone has is common with none, so
it bounds the sizes that the set can link to, its reach.  Of two that link, the
smaller reaches its own size; any other member needs such a one in its hub,
within the reach of both, or it leaves these hubs.  What is left falls into
small connected parts, whose members come together with their texts; there
groups are paired, pairs of groups are filtered by size and by what their
prefixes still allow, members are expanded and verified, and links are united
to components.  Units
of more than BLOCK_MEMBERS members are dealt out as pairs of blocks, so no
task holds more than two blocks.  Links of different units are united by label
propagation.

Where only components are asked for, the blocks of a crowded unit, one of
more than PAIRED_BLOCKS, first meet a block of its representatives.  What is linked after that is dealt into blocks of
its own, and a pair of blocks that one component fills isn't looked at; all
other pairs are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import count, groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join
from shiftroll.llm.words import batches, long_lists, shingles, word_hashes
from shiftroll.llm.worker import lean
from shiftroll.session import drop_shuffles, materialise, release

BLOCK_MEMBERS = 512
#: In units of no more blocks all pairs of blocks cost less than a round by representatives.
PAIRED_BLOCKS = 4
#: Clusters that settle later than this are long chains, whose hubs are dealt out one by one.
CLUSTER_ROUNDS = 4
DENSE_CELLS = 1 << 22


class Rule(NamedTuple):
    """Words a shingle, and the least similarity in hundredths."""

    words: int = 5
    percent: int = 80

    def least_overlap(self, n):
        """Members that a set of n must share with any set it links to."""
        return -(-n * self.percent // 100)

    def prefix(self, n):
        return n - self.least_overlap(n) + 1

    def counted_below(self) -> int:
        """Upper end of the counted part of the hash range: 1.5 times the prefix's share of a set."""
        return (150 - 3 * self.percent // 2) * ((1 << 64) // 100)


def _digest(members: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    odd = members * np.uint64(0xD6E8FEB86659FD93) ^ (members >> np.uint64(29))
    return int(members.sum(dtype=np.uint64).astype(np.int64)), int((odd * odd).sum(dtype=np.uint64).astype(np.int64))


def _sets(rule: Rule):
    """Per document: size and digest of its set, the counted members, and others that the prefix may need."""
    limit = np.uint64(rule.counted_below() - 1)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(rows, 1):
            hashes, at = word_hashes(texts, lower=True)
            n, digests, counted, spare = [], [], [], []
            for a, b in zip(at, at[1:], strict=False):
                members = shingles(hashes[a:b], rule.words)
                low = int(np.searchsorted(members, limit, side="right"))
                n.append(len(members))
                digests.append(_digest(members))
                counted.append(members[:low])
                spare.append(members[low : int(rule.prefix(len(members)))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    long_lists(counted),
                    long_lists(spare),
                ],
                names=["doc_id", "n", "s1", "s2", "counted", "spare"],
            )

    return lean(run)


def components_of(edges: DataFrame, most_rounds: int | None = None) -> DataFrame:
    """Smallest node reachable from each node of (node, hub) rows: node, label.

    Each round a hub takes the smallest label of its nodes and a node that of
    its hubs; then labels jump to the label of their label.  Sums and minima
    are combined before the shuffle, so a hub of any degree is no burden.
    After ``most_rounds`` rounds a long chain may still hold several labels;
    nodes of equal label are connected then as well.
    """
    labels = materialise(edges.select("node").distinct().withColumn("label", F.col("node")))
    for done in count(1):
        hubs = edges.join(labels, "node").groupBy("hub").agg(F.min("label").alias("label"))
        lower = edges.join(hubs, "hub").groupBy("node").agg(F.min("label").alias("label"))
        # a label is a node, whose own label may be smaller by now
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = materialise(
            lower.join(jump, "label", "left")
            .join(labels.withColumnRenamed("label", "old"), "node")
            .select("node", F.coalesce("further", "label").alias("label"), "old")
        )
        changed = after.filter(F.col("label") != F.col("old")).limit(1).count()
        release(labels)
        labels = after.select("node", "label")
        if not changed or done == most_rounds:
            return labels


def _whole_sets(rule: Rule):
    """All shingles of the classes that the rows of their ids hold."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(rows, 2):
            hashes, at = word_hashes(texts, lower=True)
            cls, s1, found = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for a, b, wanted in zip(at, at[1:], s1, strict=False):
                members = shingles(hashes[a:b], rule.words)
                # an id may repeat with another text
                found.append(members if _digest(members)[0] == wanted else members[:0])
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), long_lists(found)], names=["cls", "members"])

    return lean(run)


def without_partner(docs: DataFrame, classes: DataFrame, met: DataFrame, rule: Rule) -> DataFrame:
    """cls of those (cls, n, hub) rows that can link to no other member of any of their hubs.

    A set can share all but the members that no other set here has, which
    bounds the size of the other set: its reach.  Of two linked sets the smaller
    one reaches its own size, since it reaches the other's.
    """
    met = materialise(met)  # read three times
    own = met.select("cls", "n").distinct()
    asked = own.join(classes.select("cls", "id", "s1"), "cls").select("id", "cls", "s1")
    read = lookup_join(docs.select(_id(), "text"), asked, ["id"]).select("cls", "s1", "text")
    tokens = read.mapInArrow(_whole_sets(rule), "cls long, members array<long>").select("cls", F.explode("members").alias("token"))
    holders = tokens.groupBy("token").agg(F.min("cls").alias("cls"), F.max("cls").alias("other")).filter("cls = other")
    alone = holders.groupBy("cls").agg(F.count(F.lit(1)).alias("alone"))
    shared = F.col("n") - F.coalesce("alone", F.lit(0))
    reach = F.floor(shared * (100 + rule.percent) / rule.percent + 1e-9) - F.col("n")
    rows = materialise(met.join(own.join(alone, "cls", "left").select("cls", reach.alias("reach")), "cls"))
    # one row a size in the hub's two bands
    cores = rows.filter("reach >= n").groupBy("hub", "n").agg(F.max("reach").alias("reach"))
    cores = cores.groupBy("hub").agg(F.collect_list(F.struct("n", "reach")).alias("cores"))
    partner = F.exists("cores", lambda x: (x["n"] <= F.col("reach")) & (x["reach"] >= F.col("n")))
    may = rows.join(cores, "hub").filter((F.col("reach") >= F.col("n")) | partner).select("cls").distinct()
    return own.select("cls").join(may, "cls", "left_anti")


class Sets(NamedTuple):
    """Local sets of one task as token numbers, of tokens that at least two of them have."""

    ids: np.ndarray
    sizes: np.ndarray
    tokens: list[np.ndarray]
    width: int


def _local(ids: np.ndarray, members: list[np.ndarray]) -> Sets:
    sizes = np.array([len(m) for m in members])
    values, numbers, counts = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts > 1)
    renumber = np.full(len(values), -1)
    renumber[shared[np.argsort(counts[shared], kind="stable")]] = np.arange(len(shared))  # rare first
    parts = np.split(renumber[numbers], np.cumsum(sizes)[:-1])
    return Sets(ids, sizes, [np.sort(p[p >= 0]) for p in parts], len(shared))


def _common_counts(tokens: list[np.ndarray], width: int) -> np.ndarray:
    """Common members of all pairs of sets of token numbers below width, by matrix products."""
    product = np.zeros((len(tokens), len(tokens)), dtype=np.float32)
    step = max(1, DENSE_CELLS // len(tokens))
    for start in range(0, width, step):
        matrix = np.zeros((len(tokens), min(step, width - start)), dtype=np.float32)
        for r, own in enumerate(tokens):
            a, b = np.searchsorted(own, [start, start + step])
            matrix[r, own[a:b] - start] = 1
        if matrix.any():
            product += matrix @ matrix.T
    return product.astype(np.int64)


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def link_groups(sets: Sets, rule: Rule, weights: np.ndarray, allowed: Callable | None = None) -> tuple[Union, np.ndarray]:
    """Unite linked members; the sum of the weights that each links to.

    Members of equal size and prefix are a group.  Groups pair up through
    shared prefix tokens; a pair goes on if sizes allow a link and if the
    overlap of the prefixes plus what may follow them reaches the least
    overlap.  Its members are then verified against each other by an exact
    count of common tokens.  ``allowed`` says which of an array of pairs are to
    be compared here.
    """
    m = len(sets.ids)
    union, links = Union(m), np.zeros(m, dtype=np.int64)
    groups: dict[tuple, list[int]] = {}
    for i in range(m):
        own = int(sets.sizes[i] - len(sets.tokens[i]))  # tokens of this set alone come first
        prefix = sets.tokens[i][: max(0, int(rule.prefix(sets.sizes[i])) - own)]
        if len(prefix):
            groups.setdefault((int(sets.sizes[i]), prefix.tobytes()), []).append(i)
    keys = list(groups)
    prefixes = [np.frombuffer(k[1], dtype=sets.tokens[0].dtype) for k in keys]
    n = np.array([k[0] for k in keys], dtype=np.int64)
    holders: dict[int, list[int]] = {}
    for g, prefix in enumerate(prefixes):
        for t in prefix.tolist():
            holders.setdefault(t, []).append(g)
    held = {t: np.array(gs) for t, gs in holders.items()}
    place = {(t, g): k for g, prefix in enumerate(prefixes) for k, t in enumerate(prefix.tolist())}
    compare = _Compare(sets, rule, union, links, weights, allowed)
    for g, prefix in enumerate(prefixes):
        if len(groups[keys[g]]) > 1:
            compare.pair(groups[keys[g]], groups[keys[g]])
        met = np.concatenate([held[t] for t in prefix.tolist()])
        met = met[met > g]
        if not len(met):
            continue
        others, common = np.unique(met, return_counts=True)
        least = -(-(n[g] + n[others]) * rule.percent // (100 + rule.percent))
        sized = 100 * np.minimum(n[g], n[others]) >= rule.percent * np.maximum(n[g], n[others])
        # past the end of the shorter prefix at most all the rest can be common
        rest = np.minimum(n[g], n[others])
        for h in others[sized & (common + rest >= least)].tolist():
            first = next((t for t in prefix.tolist() if (t, h) in place), None)
            if first is None:
                continue
            a, b = place[first, g], place[first, h]
            own_g = n[g] - len(sets.tokens[groups[keys[g]][0]])
            own_h = n[h] - len(sets.tokens[groups[keys[h]][0]])
            # tokens before the first common one are not common
            if min(n[g] - own_g - a, n[h] - own_h - b) * (100 + rule.percent) >= (n[g] + n[h]) * rule.percent:
                compare.pair(groups[keys[g]], groups[keys[h]])
    compare.finish()
    return union, links


class _Compare:
    """Exact verification of members: many pairs at once by a matrix product, few by merging sorted tokens."""

    def __init__(self, sets: Sets, rule: Rule, union: Union, links: np.ndarray, weights: np.ndarray, allowed: Callable | None):
        self.sets, self.rule, self.union, self.links, self.weights, self.allowed = sets, rule, union, links, weights, allowed
        self.asked: list[tuple[int, int]] = []

    def pair(self, left: list[int], right: list[int]) -> None:
        if left is right:
            self.asked.extend((i, j) for k, i in enumerate(left) for j in left[k + 1 :])
        else:
            self.asked.extend((i, j) for i in left for j in right)
        if len(self.asked) > 1 << 18:
            self.finish()

    def finish(self) -> None:
        if not self.asked:
            return
        pairs = np.array(self.asked)
        self.asked = []
        if self.allowed is not None:
            pairs = pairs[self.allowed(pairs)]
            if not len(pairs):
                return
        common = self._common(pairs)
        both = self.sets.sizes[pairs[:, 0]] + self.sets.sizes[pairs[:, 1]] - common
        for i, j in pairs[100 * common >= self.rule.percent * both].tolist():
            self.union.link(i, j)
            self.links[i] += self.weights[j]
            self.links[j] += self.weights[i]

    def _common(self, pairs: np.ndarray) -> np.ndarray:
        tokens = self.sets.tokens
        rows, numbers = np.unique(pairs, return_inverse=True)
        numbers = numbers.reshape(pairs.shape)
        if len(pairs) < 4 * len(rows):
            return np.array([len(np.intersect1d(tokens[i], tokens[j], assume_unique=True)) for i, j in pairs.tolist()], dtype=np.int64)
        product = _common_counts([tokens[i] for i in rows.tolist()], self.sets.width)
        return product[numbers[:, 0], numbers[:, 1]]


def _allowed(a: int, b: int, token: int | None, band: int, blocks: list[int], bands: list[int], prefixes: list[list[int]]):
    """Pairs to compare in blocks a and b of a unit; in a hub, those for which it is the first they share."""
    blocks, bands = np.array(blocks), np.array(bands)

    def of(pairs: np.ndarray) -> np.ndarray:
        i, j = pairs[:, 0], pairs[:, 1]
        good = np.ones(len(pairs), dtype=bool) if a == b else blocks[i] != blocks[j]
        if token is not None:
            good &= np.maximum(bands[i], bands[j]) == band
            sets = {k: set(prefixes[k]) for k in np.unique(pairs[good]).tolist()}
            for k in np.flatnonzero(good).tolist():
                good[k] = min(sets[int(i[k])] & sets[int(j[k])], default=None) == token
        return good

    return None if a == b and token is None else of


def may_link(n: np.ndarray, counted: list[np.ndarray], rule: Rule) -> np.ndarray:
    """Pairs of sets of sizes n that may link by their counted members, all other members taken as common."""
    sets = _local(np.arange(len(n)), counted)
    others = n - sets.sizes
    most = _common_counts(sets.tokens, sets.width) + np.minimum.outer(others, others)
    least = -(-np.add.outer(n, n) * rule.percent // (100 + rule.percent))
    sized = 100 * np.minimum.outer(n, n) >= rule.percent * np.maximum.outer(n, n)
    return np.argwhere(np.triu(sized & (most >= least), 1))


def _screen(rule: Rule):
    """Connected parts of each unit, or pair of blocks of one, by pairs that may link."""

    def members(batches_in: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        n = len(_UNIT) + len(_SCREENED)
        for batch in batches_in:
            lists = batch.column(n)
            at, values = np.asarray(lists.offsets), np.asarray(lists.values)
            counted = [values[a:b] for a, b in zip(at, at[1:], strict=False)]
            yield from zip(*[batch.column(k).to_pylist() for k in range(n)], counted, strict=True)

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, rows in groupby(members(batches_in), key=lambda r: r[: len(_UNIT)]):
            _, a, b, token, band = unit
            cls, n, blocks, bands, prefixes, counted = (list(x) for x in zip(*[r[len(_UNIT) :] for r in rows], strict=True))
            pairs = may_link(np.array(n), counted, rule)
            allowed = _allowed(a, b, token, band, blocks, bands, [p or [] for p in prefixes])
            if allowed is not None and len(pairs):
                pairs = pairs[allowed(pairs)]
            if not len(pairs):
                continue
            union = Union(len(cls))
            for i, j in pairs.tolist():
                union.link(i, j)
            left = np.unique(pairs).tolist()
            same = [pa.array([x] * len(left), pa.int64()) for x in unit]
            own = [[cls[i] for i in left], [blocks[i] for i in left], [cls[union.root(i)] for i in left]]
            yield pa.RecordBatch.from_arrays([*same, *(pa.array(x, pa.int64()) for x in own)], names=[*_UNIT, "cls", "block", "part"])

    return lean(run)


def _verify(rule: Rule):
    """Links inside the parts of units that the sorted rows hold one after the other."""

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, a, b, token, band, _), rows in groupby(_rows_of(batches_in), key=lambda r: r[: len(_PART)]):
            cls, members, weights, blocks, bands, prefixes = [], [], [], [], [], []
            for *_, c, s1, copies, block, own_band, prefix, text in rows:
                hashes, _ = word_hashes([text], lower=True)
                found = shingles(hashes, rule.words)
                # an id may repeat with another text, or with the same one
                if _digest(found)[0] == s1 and not (cls and c == cls[-1]):
                    cls.append(c)
                    members.append(found)
                    weights.append(copies)
                    blocks.append(block)
                    bands.append(own_band)
                    prefixes.append(prefix or [])
            if not cls:
                continue
            sets = _local(np.array(cls), members)
            union, links = link_groups(sets, rule, np.array(weights), _allowed(a, b, token, band, blocks, bands, prefixes))
            labels = [cls[union.root(i)] for i in range(len(cls))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls, pa.int64()), pa.array(labels, pa.int64()), pa.array(links, pa.int64())], names=["cls", "label", "links"]
            )

    return lean(run)


_GROUP = ["n", "p1", "p2", "thin"]
_UNIT = ["unit", "a", "b", "token", "band"]
_PART = [*_UNIT, "part"]
_SCREENED = ["cls", "n", "block", "own_band", "prefix"]
_MEMBER = ["cls", "s1", "copies", "block", "own_band", "prefix"]


def _rows_of(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    n = len(_PART) + len(_MEMBER)
    for batch, texts in batches(rows, n):
        yield from zip(*[batch.column(k).to_pylist() for k in range(n)], texts, strict=True)


# stands for a missing id in joins
_NO_ID = -(1 << 63)


def _id() -> Column:
    return F.coalesce("doc_id", F.lit(_NO_ID)).alias("id")


def classes_of(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """All documents with their class, and one row a class of equal sets.

    A class is known by 64 bits of its size and digest."""
    read = docs.select("doc_id", "text").mapInArrow(
        _sets(rule), "doc_id long, n long, s1 long, s2 long, counted array<long>, spare array<long>"
    )
    rows = materialise(read.withColumn("cls", F.xxhash64("n", "s1", "s2")))
    # rows of a class are alike but for their ids
    classes = (
        rows.filter("n > 0")
        .groupBy("cls")
        .agg(
            *[F.first(c).alias(c) for c in ("n", "s1", "counted", "spare")],
            F.min(_id()).alias("id"),
            F.min("doc_id").alias("first_id"),
            F.count(F.lit(1)).alias("copies"),
        )
    )
    members, classes = materialise(rows.select("doc_id", "n", "cls")), materialise(classes)
    release(rows)
    return members, classes


def prefixes_of(classes: DataFrame, rule: Rule) -> DataFrame:
    """The part of each class's prefix that other classes may have as well: cls, n, prefix."""
    # shuffled once: the count reads the same rows and columns as the join, which asks for a class
    counted = classes.filter("cls IS NOT NULL").select("cls", F.explode("counted").alias("token")).repartition("token")
    shared = counted.groupBy("token").agg(F.count("cls").alias("df")).filter("df > 1")
    met = counted.join(shared, "token").groupBy("cls").agg(F.collect_list(F.struct("df", "token")).alias("met"))
    need = F.col("n") - F.floor((F.col("n") * rule.percent + 99) / 100) + 1
    alone = F.col("n_counted") - F.size("met")
    held = (
        classes.select("cls", "n", F.size("counted").alias("n_counted"), "spare")
        .join(met, "cls", "left")
        .withColumn("met", F.coalesce("met", F.array().cast("array<struct<df:bigint,token:bigint>>")))
        .withColumn("need", F.greatest(need - alone, F.lit(0)).cast("int"))
    )
    by_df = F.transform(F.slice(F.array_sort("met"), 1, F.col("need")), lambda x: x["token"])
    others = F.slice("spare", 1, F.greatest(F.col("need") - F.size("met"), F.lit(0)))
    return held.select("cls", "n", F.concat(by_df, others).alias("prefix")).filter(F.size("prefix") > 0)


def _united(linked: DataFrame) -> DataFrame:
    """cls, label of (cls, label) rows, in which a class may have several labels."""
    if linked.groupBy("cls").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").isEmpty():
        return linked.select("cls", "label")
    return components_of(linked.select(F.col("cls").alias("node"), F.col("label").alias("hub")).distinct()).withColumnRenamed("node", "cls")


def _told(members: DataFrame, classes: DataFrame, linked: DataFrame) -> DataFrame:
    """doc_id, n, cls, label and component_id of all documents; those without words have no label."""
    labels = classes.select("cls", "first_id").join(_united(linked), "cls", "left")
    told = materialise(labels.withColumn("label", F.coalesce("label", "cls")))
    first = told.groupBy("label").agg(F.min("first_id").alias("component_id"))
    per_class = told.join(first, "label").select("cls", "label", "component_id")
    columns = ["doc_id", "n", "cls", "label", "component_id"]
    with_words = members.filter("n > 0").join(per_class, "cls").select(*columns)
    without = members.filter("n = 0").withColumns({"label": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    return with_words.unionByName(without.select(*columns))


def links_of(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every document.

    A document without words (NULL, empty or blank text) has an empty set,
    links to nothing and is its own component.  Repeated rows link to each
    other.  component_id is the smallest id of the component, NULL if it has
    none.  n_links counts the other rows that a row links to directly, so all
    pairs that may link are verified; ``components`` does with fewer.  An
    empty table gives an empty one; columns besides doc_id and text are not
    read.
    """
    members, classes = classes_of(docs, rule)
    candidates = units_of(docs, classes, rule)
    linked = materialise(_verified(docs, _screened(candidates, _in_pairs(candidates.select("cls", F.inline("units"))), rule), rule))
    counted = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    others = classes.select("cls", "copies").join(counted, "cls", "left")
    n_links = others.select("cls", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    told = _told(members, classes, linked)
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    with_words = told.filter("n > 0").join(n_links, "cls").select(*columns, "n_links")
    return with_words.unionByName(told.filter("n = 0").select(*columns, F.lit(0).cast("long").alias("n_links")))


def _components(docs: DataFrame, rule: Rule) -> DataFrame:
    members, classes = classes_of(docs, rule)
    return _told(members, classes, _spanning(docs, units_of(docs, classes, rule), rule))


def components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles and component_id of every document, as ``links_of`` has them."""
    return _components(docs, rule).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _grouped(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of equal size, prefix and thinness, and their (node, hub) rows, each hub with its members."""
    groups = materialise(
        keyed.groupBy(*_GROUP, "own_band").agg(
            F.min("cls").alias("node"), F.first("prefix").alias("prefix"), F.count(F.lit(1)).alias("size")
        )
    )
    met = (
        groups.select("node", "size", "own_band", "thin", F.explode("prefix").alias("token"))
        .withColumn("band", F.explode(F.array(F.col("own_band"), F.col("own_band") + 1)))
        .select("node", "size", "token", "band", (F.col("own_band") == F.col("band")).alias("own"), "thin")
    )
    return groups, met


_HUB = ["token", "band"]


def _hubs(met: DataFrame, *more: Column) -> DataFrame:
    """Hubs of several members, and how many."""
    # a pair meets in the larger of its two bands, so a hub without a member of its own band pairs nobody
    found = met.groupBy(*_HUB).agg(F.sum("size").alias("hub_members"), F.max("own").alias("any_own"), *more)
    return found.filter("hub_members > 1 AND any_own").drop("any_own")


def _in_hubs(met: DataFrame) -> DataFrame:
    """The rows of hubs of several members, with the smallest node of the hub."""
    # shuffled once: the counts read the same columns as the join, which is why "own" stays
    dealt = met.drop("thin").repartition(*_HUB)
    return materialise(dealt.join(_hubs(dealt, F.min("node").alias("low")), _HUB))


def stars_of(edges: DataFrame) -> DataFrame:
    """(node, hub) rows that connect the same nodes as ``edges`` with their hubs' smallest nodes for hubs.

    Nodes that meet in many hubs meet in few of these, and a node has the same
    label as its hubs here if it has that of its hubs there."""
    return materialise(edges.select("node", F.col("low").alias("hub")).distinct())


def units_of(docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """id, cls, n, s1, copies, counted, own_band, prefix and the units of each class that may link to another."""
    prefixes = materialise(prefixes_of(classes, rule))
    drop_shuffles(docs.sparkSession)
    # sizes that allow a link are at most one band apart
    own_band = F.floor(F.log("n") / math.log(100 / rule.percent) + 1e-9).cast("long")
    keyed = prefixes.withColumns({"p1": F.xxhash64("prefix"), "p2": F.hash("prefix"), "own_band": own_band, "thin": F.lit(False)})
    groups, met = _grouped(keyed)
    large = materialise(_hubs(met).filter(F.col("hub_members") > BLOCK_MEMBERS).select(*_HUB))
    if not large.isEmpty():
        rows = lookup_join(met.select("node", *_HUB), large, _HUB).select("node", F.xxhash64(*_HUB).alias("hub"))
        crowded = keyed.join(groups.select(*_GROUP, "node"), _GROUP).join(rows, "node")
        thin = without_partner(docs, classes, crowded.select("cls", "n", "hub"), rule)
        thinned = keyed.drop("thin").join(thin.withColumn("thin", F.lit(True)), "cls", "left")
        keyed = materialise(thinned.withColumn("thin", F.coalesce("thin", F.lit(False))))
        release(groups)
        groups, met = _grouped(keyed)
        left = lookup_join(met, large.withColumn("large", F.lit(True)), _HUB, "left")
        met = left.filter(~F.col("thin") | F.col("large").isNull()).drop("large")
    edges = _in_hubs(met)
    stars = stars_of(edges)
    drop_shuffles(docs.sparkSession)
    labels = components_of(stars, CLUSTER_ROUNDS)
    # a cluster is settled if each of its hubs knows its label only
    labelled = stars.join(labels, "node")
    mixed = labelled.groupBy("hub").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
    unsettled = labelled.join(mixed.select("hub"), "hub", "left_semi").select("label").distinct()
    blocks_of = lambda c: F.ceil(F.col(c) / BLOCK_MEMBERS).cast("long")
    chained = edges.withColumn("rows", F.col("size") * blocks_of("hub_members")).groupBy("node").agg(F.sum("rows").alias("rows"))
    sized = labels.join(chained, "node").join(groups.select("node", "size"), "node")
    clusters = sized.groupBy("label").agg(F.sum("size").alias("members"), F.sum("rows").alias("rows"))
    # rows to deal out: the whole cluster's in blocks, or each hub's
    small = F.col("members") * blocks_of("members") <= F.col("rows")
    dealt = clusters.join(unsettled.withColumn("unsettled", F.lit(True)), "label", "left")
    placed = materialise(labels.join(dealt.withColumn("whole", small & F.col("unsettled").isNull()), "label"))
    nothing = F.lit(None).cast("long")
    whole = placed.filter("whole").select(
        "node", F.struct(F.col("label").alias("unit"), "members", nothing.alias("token"), nothing.alias("band")).alias("u")
    )
    by_hub = edges.join(placed.filter("not whole").select("node"), "node").select(
        "node", F.struct(F.xxhash64(*_HUB).alias("unit"), F.col("hub_members").alias("members"), "token", "band").alias("u")
    )
    units = whole.unionByName(by_hub).groupBy("node").agg(F.collect_list("u").alias("units"))
    of_group = groups.select(*_GROUP, "node").join(units, "node").drop("node")
    candidates = materialise(
        keyed.join(of_group, _GROUP)
        .select("cls", "n", "own_band", F.when(F.col("units")[0]["token"].isNotNull(), F.col("prefix")).alias("prefix"), "units")
        .join(classes.select("cls", "id", "s1", "copies", "counted"), "cls")
    )
    release(prefixes, keyed, groups, large, edges, stars, labels, placed)
    return candidates


def _blocks(rows: str) -> Column:
    return F.ceil(F.col(rows) / BLOCK_MEMBERS).cast("long")


def _block_of(blocks: str) -> Column:
    return F.pmod(F.xxhash64("cls"), F.col(blocks)).cast("long")


def _with_block(other: Column) -> Column:
    return F.struct(F.least(other, F.col("block")).alias("a"), F.greatest(other, F.col("block")).alias("b"))


def _in_pairs(units: DataFrame) -> DataFrame:
    """cls, unit, token, band, block and the pairs of blocks that a member of a unit goes to: all with its own."""
    placed = units.withColumn("n_blocks", _blocks("members"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1), _with_block)
    return placed.withColumn("block", _block_of("n_blocks")).withColumn("pairs", pairs).drop("members", "n_blocks")


def _spanning(docs: DataFrame, candidates: DataFrame, rule: Rule) -> DataFrame:
    """(cls, label) rows that connect what is linked.

    In units of more than PAIRED_BLOCKS blocks of members, block 0 holds the
    representatives and meets all others first.  Then every large component of
    the members left has blocks of its own there, and the rest shares some."""

    def verified(dealt: DataFrame) -> DataFrame:
        return materialise(_verified(docs, _screened(candidates, dealt, rule), rule).select("cls", "label"))

    units = candidates.select("cls", F.inline("units"))
    crowded = units.filter(F.col("members") > PAIRED_BLOCKS * BLOCK_MEMBERS)
    if crowded.isEmpty():
        return verified(_in_pairs(units))
    of_unit = Window.partitionBy("unit", "token", "band")
    chosen = crowded.withColumn("nth", F.row_number().over(of_unit.orderBy(F.xxhash64("cls"), "cls"))).filter(F.col("nth") <= BLOCK_MEMBERS)
    chosen = chosen.select("cls", "unit", F.lit(True).alias("chosen"))
    zero = F.lit(0).cast("long")
    met = materialise(
        crowded.join(chosen, ["cls", "unit"], "left")
        .withColumns({"chosen": F.coalesce("chosen", F.lit(False)), "n_blocks": _blocks("members")})
        .withColumn("block", F.when(F.col("chosen"), zero).otherwise(_block_of("n_blocks") + 1))
    )
    stars = met.withColumn("pairs", F.when(F.col("chosen"), F.transform(F.sequence(zero, F.col("n_blocks")), _with_block)).otherwise(F.array(_with_block(zero))))
    small = _in_pairs(units.filter(F.col("members") <= PAIRED_BLOCKS * BLOCK_MEMBERS))
    columns = ["cls", "unit", "token", "band", "block", "pairs"]
    first = verified(stars.select(*columns).unionByName(small.select(*columns)))

    # representatives have met everybody
    left = met.filter(~F.col("chosen")).select("cls", "unit", "token", "band").join(_united(first), "cls", "left")
    left = materialise(left.withColumn("label", F.coalesce("label", "cls")))
    sizes = left.groupBy("unit", "label").agg(F.count(F.lit(1)).alias("rows"))
    large = sizes.filter(F.col("rows") >= BLOCK_MEMBERS).withColumn("own_blocks", _blocks("rows"))
    before = Window.partitionBy("unit").orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    large = large.withColumn("start", F.coalesce(F.sum("own_blocks").over(before), zero))
    of_all = large.groupBy("unit").agg(F.sum("own_blocks").alias("large_blocks"), F.sum("rows").alias("large_rows"))
    whole = (
        sizes.groupBy("unit")
        .agg(F.sum("rows").alias("rows"))
        .join(of_all, "unit", "left")
        .select("unit", F.coalesce("large_blocks", zero).alias("large_blocks"), (F.col("rows") - F.coalesce("large_rows", zero)).alias("rest"))
        .withColumn("rest_blocks", _blocks("rest"))
    )
    n_all = F.col("large_blocks") + F.col("rest_blocks")
    own = F.col("own_blocks").isNotNull()
    others = F.filter(
        F.sequence(zero, n_all - 1), lambda k: ~F.coalesce((k >= F.col("start")) & (k < F.col("start") + F.col("own_blocks")), F.lit(False))
    )
    dealt = (
        left.join(large.drop("rows"), ["unit", "label"], "left")
        .join(whole, "unit")
        .withColumn("block", F.when(own, F.col("start") + _block_of("own_blocks")).otherwise(F.col("large_blocks") + _block_of("rest_blocks")))
        .withColumn("pairs", F.transform(others, _with_block))
        .select(*columns)
    )
    second = verified(dealt.filter(F.size("pairs") > 0))
    release(met, left)
    return first.unionByName(second)


def _screened(candidates: DataFrame, dealt: DataFrame, rule: Rule) -> DataFrame:
    """The candidates that may link to another by their counted members, and the parts they belong to.

    ``dealt`` says to which pairs of blocks of which units they go."""
    rows = (
        candidates.select("cls", "n", "own_band", "prefix", "counted")
        .join(dealt, "cls")
        .withColumn("pair", F.explode("pairs"))
        .select("unit", "pair.a", "pair.b", "token", "band", *_SCREENED, "counted")
    )
    parts = (
        rows.repartition("unit", "a", "b")
        .sortWithinPartitions("unit", "a", "b", "cls")
        .mapInArrow(_screen(rule), "unit long, a long, b long, token long, band long, cls long, block long, part long")
    )
    of_class = materialise(parts.groupBy("cls").agg(F.collect_list(F.struct(*_PART, "block")).alias("parts")))
    return candidates.select("cls", "id", "s1", "copies", "own_band", "prefix").join(of_class, "cls")


def _verified(docs: DataFrame, candidates: DataFrame, rule: Rule) -> DataFrame:
    """cls, label, links inside each part of the units."""
    dealt = (
        lookup_join(docs.select(_id(), "text"), candidates, ["id"])
        .select("*", F.inline("parts"))
        .select(*_PART, *_MEMBER, "text")
    )
    return (
        dealt.repartition(*_PART)
        .sortWithinPartitions(*_PART, "cls")
        .mapInArrow(_verify(rule), "cls long, label long, links long")
    )


def first_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One document of each component, one with the smallest id; documents without words stay.

    Of several texts under that id in one component one stays, the same in each
    run.  Rows alike in id and text count once.  In a component whose rows all
    have no id, one of them stays.
    """
    told = materialise(_components(docs, rule).withColumn("id", _id()))
    own = told.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    own = own.withColumn("of", F.coalesce("label", "cls")).groupBy("id", "of").agg(F.min("cls").alias("cls"))
    kept = materialise(own.join(told.groupBy("id").agg((F.count(F.lit(1)) > 1).alias("repeated")), "id"))
    keyed = docs.withColumn("_kept_id", _id())
    once = keyed.join(kept.filter("NOT repeated").select(F.col("id").alias("_kept_id")), "_kept_id", "left_semi").select(*docs.columns)
    repeated = kept.filter("repeated").select(F.col("id").alias("_kept_id"), F.col("cls").alias("_kept_class"))
    if repeated.isEmpty():
        return once
    # an id with several rows says nothing of the row: its text does
    again = keyed.join(repeated.select("_kept_id").distinct(), "_kept_id", "left_semi").withColumn("_text_key", F.xxhash64("text"))
    read = again.select(F.col("_text_key").alias("doc_id"), "text").distinct().mapInArrow(
        _sets(rule), "doc_id long, n long, s1 long, s2 long, counted array<long>, spare array<long>"
    )
    classed = read.select(F.col("doc_id").alias("_text_key"), F.xxhash64("n", "s1", "s2").alias("_kept_class"), (F.col("n") == 0).alias("_bare"))
    # texts without words are one class, but none of each other's copies
    alike = F.when(F.col("_bare"), F.col("text"))
    rows = again.join(classed.distinct(), "_text_key").join(repeated, ["_kept_id", "_kept_class"], "left_semi")
    rows = rows.withColumn("_alike", alike).withColumn("_null", F.col("text").isNull())
    order = Window.partitionBy("_kept_id", "_kept_class", "_alike", "_null").orderBy("text")
    return once.unionByName(rows.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").select(*docs.columns))
