"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its five-word shingles; documents with equal sets are one class
from the start. In each of a number of trees the classes branch by the minimum hash at
chosen coordinates: a node picks one coordinate by its own hash, and with a chance of a
third a second one (4/3 on average, the inverse of the similarity 0.75), and its members
fall into a child for each value. Nodes of at most ``SMALL_NODE`` members are compared
exhaustively by their signatures; larger ones branch again.

Links are confirmed on full sets, and only where they can join two components of those
confirmed before:

1. Large groups. Nodes of the first level that are too large to compare are compared with
   one member, again with another one that is not in their main component, and so on while
   this at least halves the members outside of it. Each round costs a node one pair for a
   member. A group of copies is one component then and its nodes are closed.
2. Forests. Every small node gives the likeliest links of a spanning forest.
3. The rest. Every pair of a node that may be similar enough and has its ends in two
   components. Pairs are not given on: their members get their texts and the task of the node
   compares the full sets, so that only links leave it, fewer than the node has members. A
   pair that several nodes hold is compared in one of them.

A large node whose members outside its main component are few enough for one task is not
branched: these are compared with all its members, in blocks. So is a node that is still
large after ``MOST_LEVELS`` levels, block by block, each pair of blocks in a task of its own
with a bounded number of rows. Blocks miss no pair, so no depth needs more trees than
``MOST_LEVELS`` does.

Recall: ``missed`` is the chance that a pair with the least similarity is not confirmed,
by the levels its nodes needed and the number of trees; what a signature of 128 values
leaves out is in it. ``TREES`` trees come first. Where they needed more levels than that
number is good for, more trees follow for the classes that went so deep, until the chance is
at most ``MOST_MISSED`` at ``MOST_LEVELS``; nodes inside one component are left out of them,
as no pair of theirs can change a component.

Rules for odd input: NULL and texts without words have no shingles and link with nothing;
texts of one to four words are one shingle of that length; rows that repeat an identifier,
with equal or with different texts, are copies or near copies like any others and get one
result each; rows with a NULL identifier are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import written
from tablecheck.llm.components import components
from tablecheck.llm.words import WordHashes, run_hashes

SHINGLE = 5
#: Links need 100 * intersection >= LEAST_PERCENT * union.
LEAST_PERCENT = 75
COORDINATES = 128
#: Trees that all classes branch in.
TREES = 10
#: Chance to miss a pair of the least similarity that is accepted.
MOST_MISSED = 0.001
#: Levels after which large nodes are compared in blocks.
MOST_LEVELS = 8
SMALL_NODE = 1024
#: Pairs whose signatures agree in a smaller share of places are not confirmed.
LEAST_ESTIMATE = 0.6
#: Trees whose first level shows the large groups.
FIRST_TREES = 3
#: Pairs, or members of a cell with their texts, that are worth a task of their own.
TEXTS_A_TASK = 2_000
#: More candidate documents than this are found by a shuffle (8 bytes each).
MOST_BROADCAST = 2_000_000

_random = np.random.default_rng(20240607)
FLIP = _random.integers(0, 2**32, COORDINATES, dtype=np.uint32)
FACTOR = _random.integers(0, 2**31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

DOCUMENTS = "doc_id long, n_shingles long, key1 long, key2 long, signature array<int>"


class Shingles:
    """Sets of shingle hashes of texts."""

    def __init__(self) -> None:
        self.words = WordHashes()

    def of(self, text: str | None) -> np.ndarray:
        """Distinct hashes, sorted."""
        words = text.encode("utf-8").lower().split() if text else []
        hashes = self.words.of(words)
        length = min(SHINGLE, len(words))
        return np.unique(run_hashes(hashes, length)) if length else np.empty(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum over the set at every coordinate."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(COORDINATES, 2**32 - 1, np.uint32)
    for at in range(0, len(short), 1024):
        part = (short[None, at : at + 1024] ^ FLIP[:, None]) * FACTOR[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def shingle_table(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row for each document: size of its set, 128-bit key of the set, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles.of(text)
                sizes.append(len(found))
                keys.append(set_key(found))
                signatures.append(signature(found).view(np.int32))
            halves = np.array(keys, np.int64).reshape(-1, 2)
            flat = np.concatenate(signatures) if signatures else np.empty(0, np.int32)
            offsets = np.arange(0, len(flat) + 1, COORDINATES, dtype=np.int32)
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(halves[:, 0].copy()),
                pa.array(halves[:, 1].copy()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            ]
            names = ["doc_id", "n_shingles", "key1", "key2", "signature"]
            yield pa.RecordBatch.from_arrays(columns, names)

    chosen = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("t"))
    return chosen.where("doc_id IS NOT NULL").mapInArrow(run, DOCUMENTS)


def missed(depth: int, trees: int) -> float:
    """Chance that no tree brings a pair of the least similarity to confirmation.

    ``depth`` is the level at which the nodes are small enough. Given the number of equal
    places of the two signatures, a pair's shared nodes are a branching process.
    """
    least, total = LEAST_PERCENT / 100, 0.0
    for equal in range(COORDINATES + 1):
        chance = comb(COORDINATES, equal) * least**equal * (1 - least) ** (COORDINATES - equal)
        share, lost = equal / COORDINATES, 0.0
        for _ in range(depth):
            child = 1 - share + share * lost
            lost = child * (2 + child) / 3
        total += chance * (lost**trees if share >= LEAST_ESTIMATE else 1.0)
    return total


def trees_for(depth: int) -> int:
    """Trees that a depth needs; asked for ``MOST_LEVELS`` at most."""
    trees = TREES
    while missed(depth, trees) > MOST_MISSED:
        trees += 1
    return trees


def _branch(members: DataFrame, most: int | None = None) -> DataFrame:
    """(node, rep, label, size) of the children of all nodes that can still join two components.

    A node takes one coordinate by its own hash, and in a third of the cases another one too.
    """

    def child(coordinate: Column) -> Column:
        return F.xxhash64("node", coordinate, F.get("signature", coordinate))

    first = F.pmod(F.xxhash64("node", F.lit("one")), F.lit(COORDINATES)).cast("int")
    step = F.pmod(F.xxhash64("node", F.lit("other")), F.lit(COORDINATES - 1)).cast("int") + 1
    both = F.pmod(F.xxhash64("node", F.lit("two")), F.lit(3)) == 0
    keys = F.array(child(first), F.when(both, child((first + step) % COORDINATES)))
    rows = members.select("rep", "label", F.explode(keys).alias("node"))
    return _sized(rows.where("node IS NOT NULL"), most and 2 * most)


def _sized(rows: DataFrame, most: int | None) -> DataFrame:
    """Rows (node, rep, label) of the nodes whose members have more than one label, with the
    size of the node, its main label and the number of members that have another one. There
    are ``most`` rows at most."""
    # written first, so that the join can be split where one node has a large part of the rows
    labels = rows.groupBy("node", "label").agg(F.count("*").alias("n"))
    sizes = labels.groupBy("node").agg(
        F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("top")
    )
    sizes = sizes.where("top.n < size").selectExpr("node", "size", "size - top.n AS others", "top.label AS main")
    return written(rows.join(written(sizes, most).hint("merge"), "node"), most)


def _roots(classes: DataFrame, trees: range, count: int) -> DataFrame:
    """The first level: children of the root of every tree, of ``count`` classes."""
    keys = []
    for tree in trees:
        pick = np.random.default_rng([20240607, tree])
        for c in pick.choice(COORDINATES, 2 if tree % 3 == 0 else 1, replace=False).tolist():
            keys.append(F.xxhash64(F.lit(tree), F.lit(c), F.get("signature", F.lit(c))))
    nodes = classes.select("rep", "label", F.explode(F.array(*keys)).alias("node"))
    return _sized(nodes, count * len(keys))


def _near_places(
    signatures: np.ndarray, labels: np.ndarray, sides: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each row that others are compared with, the places and shares of those that may be
    similar enough and have another label: all later rows of a whole node, the rows of the
    second block where a cell has one."""
    signatures = signatures.astype(np.uint16)
    second = np.flatnonzero(sides)
    for i in np.flatnonzero(sides == 0).tolist():
        open_ = second if len(second) else np.arange(i + 1, len(labels))
        open_ = open_[labels[open_] != labels[i]]
        if len(open_):
            share = (signatures[open_] == signatures[i]).mean(axis=1)
            near = share >= LEAST_ESTIMATE
            yield i, open_[near], share[near]


def _forest(reps: np.ndarray, labels: np.ndarray, found: list) -> list[tuple[int, int]]:
    """Of the pairs found, those of a spanning forest of the labels, the likeliest first."""
    names, own = np.unique(labels, return_inverse=True)
    parent = list(range(len(names)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first = np.concatenate([np.full(len(near), i) for i, near, _ in found])
    second, share = (np.concatenate([f[k] for f in found]) for k in (1, 2))
    pairs = []
    for k in np.argsort(-share, kind="stable").tolist():
        a, b = root(own[first[k]]), root(own[second[k]])
        if a != b:
            pairs.append((int(reps[first[k]]), int(reps[second[k]])))
            parent[a] = b
    return pairs


def _told_here(node: int, own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether ``node`` is the least of the nodes that a row shares with each other row; rows
    of ``others`` are the nodes of a row, padded with 0."""
    shared = np.isin(others, own[own != 0])
    least = np.where(shared, others, np.iinfo(np.int64).max).min(axis=1)
    return least == node


def _padded(lists: list[list[int]]) -> np.ndarray:
    """Lists of numbers as rows, padded with 0."""
    rows = np.zeros((len(lists), max(map(len, lists), default=0)), np.int64)
    for row, values in enumerate(lists):
        rows[row, : len(values)] = values
    return rows


def _signatures(table: pa.Table) -> np.ndarray:
    flat = table.column("signature").combine_chunks().flatten().to_numpy()
    return flat.view(np.uint32).reshape(table.num_rows, -1)


def _pairs_table(pairs: list[tuple[int, int]]) -> pa.Table:
    ends = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.table({"u": ends[:, 0], "v": ends[:, 1]})


def _cell_by_cell(
    members: DataFrame, columns: list[str], handle: Callable[[pa.Table], pa.Table | None], schema: str
) -> DataFrame:
    """What ``handle`` gives for all rows of every cell; cells are dealt to tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            edges = np.r_[0, np.flatnonzero(cells[1:] != cells[:-1]) + 1, len(cells)].tolist()
            found = []
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if held and cells[a] != last:
                    found.append(handle(pa.Table.from_batches(held)))
                    held = []
                last = int(cells[a])
                held.append(batch.slice(a, b - a))
            yield from packed(found)
        if held:
            yield from packed([handle(pa.Table.from_batches(held))])

    def packed(found: list[pa.Table | None]) -> Iterator[pa.RecordBatch]:
        tables = [x for x in found if x is not None]
        if tables:
            yield from pa.concat_tables(tables).combine_chunks().to_batches()

    dealt = members.select(*columns).repartition("cell").sortWithinPartitions("cell", "rep")
    return dealt.mapInArrow(run, schema)


def _forest_pairs(members: DataFrame) -> DataFrame:
    """Pairs of every cell that could join two components (``label``) of the links so far,
    those of a spanning forest."""

    def pairs_of(table: pa.Table) -> pa.Table | None:
        reps, labels, sides = (table.column(c).to_numpy() for c in ("rep", "label", "side"))
        found = list(_near_places(_signatures(table), labels, sides))
        return _pairs_table(_forest(reps, labels, found)) if found else None

    columns = ["cell", "rep", "label", "side", "signature"]
    return _cell_by_cell(members, columns, pairs_of, "u long, v long")


OPEN = "cell long, node long, rep long, label long, side int, nodes array<long>"


def _open_members(members: DataFrame) -> DataFrame:
    """The members of every cell that are in a pair that could join two components and that
    this cell has to compare."""
    columns = [x.split()[0] for x in OPEN.split(", ")]

    def open_of(table: pa.Table) -> pa.Table | None:
        labels, sides = (table.column(c).to_numpy() for c in ("label", "side"))
        node, nodes = table.column("node")[0].as_py(), _padded(table.column("nodes").to_pylist())
        keep = np.zeros(len(labels), bool)
        for i, near, _ in _near_places(_signatures(table), labels, sides):
            near = near[_told_here(node, nodes[i], nodes[near])]
            keep[near] = True
            keep[i] |= len(near) > 0
        return table.select(columns).filter(pa.array(keep)) if keep.any() else None

    return _cell_by_cell(members, [*columns, "signature"], open_of, OPEN)


def _node_links(
    reps: np.ndarray, labels: np.ndarray, sides: np.ndarray, node: int, nodes: np.ndarray, sets: list
) -> list[tuple[int, int]]:
    """Links of a cell by the full sets, one for each two components that it joins."""
    labels, sizes = labels.copy(), np.array([len(x) for x in sets])
    names = np.unique(np.concatenate(sets))
    places = [np.searchsorted(names, x).astype(np.int32) for x in sets]
    marked = np.zeros(len(names), bool)
    second, links = np.flatnonzero(sides), []
    for i in np.flatnonzero(sides == 0).tolist():
        open_ = second if len(second) else np.arange(i + 1, len(labels))
        open_ = open_[labels[open_] != labels[i]]
        least, most = np.minimum(sizes[open_], sizes[i]), np.maximum(sizes[open_], sizes[i])
        open_ = open_[100 * least >= LEAST_PERCENT * most]
        open_ = open_[_told_here(node, nodes[i], nodes[open_])] if len(open_) else open_
        if not len(open_):
            continue
        marked[places[i]] = True
        both = np.array([np.count_nonzero(marked[places[j]]) for j in open_.tolist()])
        marked[places[i]] = False
        linked = open_[100 * both >= LEAST_PERCENT * (sizes[open_] + sizes[i] - both)]
        joined, first = np.unique(labels[linked], return_index=True)
        links += [(int(reps[i]), int(reps[j])) for j in linked[first].tolist()]
        labels[np.isin(labels, joined)] = labels[i]
    return links


def _full_links(
    members: DataFrame, classes: DataFrame, df: DataFrame, id_column: str, text_column: str
) -> DataFrame:
    """Links (u, v) of the rest: the members of every cell compared by their full sets."""

    def links_of(table: pa.Table) -> pa.Table | None:
        shingles = Shingles()
        wanted = zip(table.column("key1").to_pylist(), table.column("key2").to_pylist())
        sets = [shingles.of(text) for text in table.column("text").to_pylist()]
        # an identifier may have other texts too
        own = np.flatnonzero([set_key(x) == key for x, key in zip(sets, wanted)])
        if len(own) < 2:
            return None
        reps, labels, sides = (table.column(c).to_numpy()[own] for c in ("rep", "label", "side"))
        nodes = _padded(table.column("nodes").to_pylist())[own]
        node = table.column("node")[0].as_py()
        links = _node_links(reps, labels, sides, node, nodes, [sets[i] for i in own])
        return _pairs_table(links) if links else None

    reps, most = members.select("rep").distinct(), members.count()
    held = _texts_of(reps, most, classes, df, id_column, text_column)
    rows = members.join(held.hint("merge"), "rep")
    columns = [x.split()[0] for x in OPEN.split(", ")]
    return _cell_by_cell(rows, [*columns, "key1", "key2", "text"], links_of, "u long, v long")


def _blocks(large: DataFrame) -> DataFrame:
    """(cell, node, rep, side): large nodes cut into blocks, one cell for each pair of blocks.

    Members outside the main label and those inside are dealt to blocks of their own; a pair
    of blocks of the main label holds no pair that is open, and is left out.
    """
    half = max(1, SMALL_NODE // 2)
    h = F.xxhash64("rep", "node")
    outside = F.ceil(F.col("others") / half)
    inside = F.ceil((F.col("size") - F.col("others")) / half)
    own = F.when(F.col("label") != F.col("main"), F.pmod(h, outside)).otherwise(
        outside + F.pmod(h, inside)
    )
    rows = large.select("node", "rep", outside.alias("outside"), (outside + inside - 1).alias("last"), own.alias("own"))

    def cells(ends: Column, pair, side: int) -> Column:
        return F.transform(
            ends, lambda i: F.struct(F.xxhash64(*pair(i)).alias("cell"), F.lit(side).alias("side"))
        )

    none = F.array().cast("array<struct<cell:bigint,side:int>>")
    node, mine = F.col("node"), F.col("own")
    leads = cells(F.sequence(mine, F.col("last")), lambda i: (node, mine, i), 0)
    follows = cells(
        F.sequence(F.lit(0).cast("long"), F.least(mine, F.col("outside")) - 1), lambda i: (node, i, mine), 1
    )
    both = F.concat(
        F.when(mine < F.col("outside"), leads).otherwise(none),
        F.when(mine > 0, follows).otherwise(none),
    )
    return rows.select("node", "rep", F.inline(both)).select("cell", "node", "rep", "side")


def _pivot_pairs(large: DataFrame, signatures: DataFrame, count: int) -> DataFrame:
    """Pairs of one member of each large node, outside its main label where there is a choice
    of pairs left, with all members that may be similar enough and have another label."""
    order = F.struct((F.col("label") == F.col("main")).alias("m"), F.xxhash64("rep", "node").alias("o"), "rep", "label")
    pivot = large.groupBy("node").agg(F.min(order).alias("p"))
    pivot = pivot.select("node", F.col("p.rep").alias("pivot"), F.col("p.label").alias("pivot_label"))
    own = signatures.select(F.col("rep").alias("pivot"), F.col("signature").alias("pivot_signature"))
    # a node has more than SMALL_NODE members
    pivot = written(pivot.join(own.hint("merge"), "pivot"), count)
    open_ = large.select("node", "rep", "label").join(
        pivot.select("node", "pivot", "pivot_label").hint("merge"), "node"
    )
    # of one class and pivot once, however many nodes hold both
    open_ = open_.where("label <> pivot_label").select("rep", "pivot").distinct()
    laid = open_.join(signatures.select("rep", "signature").hint("merge"), "rep").join(
        own.hint("merge"), "pivot"
    )
    near = laid.where(_agreement("signature", "pivot_signature") >= LEAST_ESTIMATE)
    return near.select(F.col("pivot").alias("u"), F.col("rep").alias("v"))


def _agreement(a: str, b: str) -> Column:
    """Share of equal places of two signatures."""
    same = F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0))
    return F.aggregate(same, F.lit(0), lambda total, x: total + x) / F.lit(COORDINATES)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _labelled(classes: DataFrame, labels: DataFrame, count: int) -> DataFrame:
    """(rep, signature, label): the component of every one of ``count`` classes, itself where it
    has no link."""
    label = F.coalesce("component", "rep").alias("label")
    known = classes.join(labels.hint("merge"), F.col("rep") == F.col("node"), "left")
    return written(known.select("rep", "signature", label), count)


def candidate_cells(known: DataFrame, trees: range) -> tuple[DataFrame, DataFrame, int]:
    """(cell, node, rep, side): what has to be compared of classes (rep, signature, label);
    the classes that went deeper than so many trees are good for; the levels needed."""
    cells, signatures, count = [], known, known.count()
    members, deep = _roots(known, trees, count), known.select("rep").limit(0)
    for depth in range(1, MOST_LEVELS + 1):
        # joins by merging and a staged result for each level keep the driver out of it
        largest, most = members.agg(F.max("size"), F.count("*")).first()
        largest = largest or 0
        small = members.where(F.col("size") <= SMALL_NODE)
        cells.append(small.select(F.col("node").alias("cell"), "node", "rep", F.lit(0).alias("side")))
        if largest <= SMALL_NODE:
            break
        large = members.where(F.col("size") > SMALL_NODE)
        ends = F.lit(depth == MOST_LEVELS) | (F.col("others") <= SMALL_NODE)
        cells.append(_blocks(large.where(ends)))
        rest = large.where(~ends).select("node", "rep")
        if rest.isEmpty():
            break
        # what goes on needs the signatures of ever fewer classes
        wanted = rest.select("rep").distinct().hint("merge")
        signatures = written(signatures.join(wanted, "rep", "left_semi"), min(most, count))
        members = _branch(rest.join(signatures.hint("merge"), "rep"), most)
        if missed(depth, len(trees)) <= MOST_MISSED < missed(depth + 1, len(trees)):
            deep = written(members.select("rep").distinct(), count)
    return written(reduce(DataFrame.unionByName, cells)), deep, depth


def _laid(cells: DataFrame, known: DataFrame, forest: bool) -> DataFrame:
    """Cells that hold more than one label, with label and signature of their members and, for
    the pairs that are left after the forest, the nodes each member is in."""
    labels, count = known.select("rep", "label"), cells.count()
    rows = cells.join(labels.hint("merge"), "rep")
    open_ = rows.groupBy("cell").agg(F.min("label").alias("a"), F.max("label").alias("b"))
    rows = rows.join(written(open_.where("a < b").select("cell"), count).hint("merge"), "cell")
    rows = written(rows.select("cell", "node", "rep", "label", "side"), count)
    sides = known.select("rep", "signature")
    if not forest:
        # two members of an open pair meet in one cell of every node that has both
        lists = rows.groupBy("rep").agg(F.collect_set("node").alias("nodes"))
        sides = sides.join(lists.hint("merge"), "rep")
    return rows.join(sides.hint("merge"), "rep")


def _texts_of(
    reps: DataFrame, most: int, classes: DataFrame, df: DataFrame, id_column: str, text_column: str
) -> DataFrame:
    """(rep, key1, key2, text): texts of the documents that stand for ``most`` classes (rep) at
    most.

    ``classes`` (rep, doc, key1, key2) says which document has the set of a class; the key of
    the set tells its text from other texts of the same identifier.
    """
    known = reps.join(classes.select("rep", "doc", "key1", "key2").hint("merge"), "rep")
    wanted = written(known.withColumnRenamed("doc", "id"), most)
    ids = wanted.select("id").distinct()
    side = F.broadcast(ids) if wanted.count() <= MOST_BROADCAST else ids
    texts = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    texts = texts.join(side, "id", "left_semi").dropDuplicates(["id", "text"])
    return wanted.join(texts.hint("merge"), "id").drop("id")


def confirmed(
    pairs: DataFrame, classes: DataFrame, df: DataFrame, id_column: str, text_column: str
) -> DataFrame:
    """The pairs whose full sets are similar enough. Texts travel, not their sets."""
    ends = pairs.select(F.col("u").alias("rep")).unionByName(pairs.select(F.col("v").alias("rep")))
    held = _texts_of(ends.distinct(), 2 * pairs.count(), classes, df, id_column, text_column)

    def of(end: str) -> DataFrame:
        return held.toDF(end, f"{end}_key1", f"{end}_key2", f"{end}_text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles()
        sets: dict[tuple, np.ndarray | None] = {}

        def set_of(key1: int, key2: int, text: str) -> np.ndarray | None:
            """The set of a text if it has that key."""
            if (key1, key2, text) not in sets:
                found = shingles.of(text)
                same = set_key(found) == (key1, key2)
                sets[key1, key2, text] = found if same else None
            return sets[key1, key2, text]

        for batch in batches:
            keep = []
            columns = ("u_key1", "u_key2", "u_text", "v_key1", "v_key2", "v_text")
            for values in batch[list(columns)].itertuples(index=False):
                if len(sets) > 200:
                    sets.clear()
                a, b = set_of(*values[:3]), set_of(*values[3:])
                if a is None or b is None:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= LEAST_PERCENT * (len(a) + len(b) - both))
            yield batch.loc[keep, ["u", "v"]]

    joined = pairs.join(of("u").hint("merge"), "u").join(of("v").hint("merge"), "v")
    return joined.mapInPandas(run, "u long, v long")


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), "<i8").tolist())


class _Links:
    """Links confirmed so far, the pairs tried, and the component of every class."""

    def __init__(self, classes: DataFrame, df: DataFrame, id_column: str, text_column: str):
        self.source = classes, df, id_column, text_column
        self.found = classes.selectExpr("rep AS u", "rep AS v").limit(0)
        self.tried = self.found
        self.labels = self.found.toDF("node", "component")

    def add(self, pairs: DataFrame, most: int) -> None:
        """Confirm ``most`` pairs at most."""
        new = _ordered(pairs).join(self.tried.hint("merge"), ["u", "v"], "left_anti")
        pairs = written(new, most)
        count = pairs.count()
        if not count:
            return
        self.tried = self.tried.unionByName(pairs)
        self.learn(written(confirmed(pairs, *self.source), count, TEXTS_A_TASK))

    def learn(self, found: DataFrame) -> None:
        if not found.isEmpty():
            self.found = self.found.unionByName(found)
            self.labels = components(self.found)


def _join_large_groups(signatures: DataFrame, links: _Links, count: int) -> None:
    """Link the members of large nodes with one of them, while that closes the nodes."""
    left = None
    while True:
        known = _labelled(signatures, links.labels, count)
        large = _roots(known, range(FIRST_TREES), count).where(F.col("size") > SMALL_NODE)
        nodes = large.groupBy("node").agg(F.max("others").alias("others"), F.count("*").alias("n"))
        outside, most = nodes.agg(F.sum("others"), F.sum("n")).first()
        if not outside or (left is not None and 2 * outside > left):
            return
        left = outside
        links.add(_pivot_pairs(large, signatures, most), most)


def near_duplicates(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    documents = written(shingle_table(df, id_column, text_column))
    own = documents.where("n_shingles > 0")
    # the signature is a function of the set, so any member of a class has it
    classes = own.groupBy("key1", "key2").agg(
        F.min("doc_id").alias("doc"), F.any_value("signature").alias("signature")
    )
    total = documents.count()
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), total)
    signatures = classes.select("rep", "signature")
    links = _Links(classes.drop("signature"), df, id_column, text_column)
    _join_large_groups(signatures, links, total)
    subset, trees, needed = signatures, 0, TREES
    while trees < needed:
        known = _labelled(subset, links.labels, total)
        cells, deep, depth = candidate_cells(known, range(trees, needed))
        most = cells.count()
        links.add(_forest_pairs(_laid(cells, known, True)), most)
        known = _labelled(subset, links.labels, total)
        left = written(_open_members(_laid(cells, known, False)), most)
        links.learn(written(_full_links(left, *links.source), left.count(), TEXTS_A_TASK))
        if not trees:
            subset = written(signatures.join(deep.hint("merge"), "rep", "left_semi"), total)
        trees, needed = needed, max(needed, trees_for(depth))
    named = classes.select("rep", "key1", "key2", "doc").join(
        links.labels.hint("merge"), F.col("rep") == F.col("node"), "left"
    )
    named = written(named.select("key1", "key2", "doc", F.coalesce("component", "rep").alias("component")), total)
    least = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = named.join(least.hint("merge"), "component").select("key1", "key2", "component_id")
    sized = documents.select("doc_id", "n_shingles", "key1", "key2")
    full = sized.where("n_shingles > 0").join(named, ["key1", "key2"])
    empty = sized.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return full.select(*columns).unionByName(empty.select(*columns))
