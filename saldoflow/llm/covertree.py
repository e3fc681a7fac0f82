"""Near-duplicate vectors by dual traversal of cover trees.

Vectors of one label and dimension form a space of their own. Scaled to length one, a
cosine of at least t is a distance of at most sqrt(2 - 2 t). Nodes cover their vectors
with a measured radius, and the radii of nested levels halve. Two nodes further apart than
their radii and the link distance hold no link; two so close that no pair below them can
miss it are linked as a whole; others are compared by their children, and single vectors
by the cosine itself in double precision, so the links are exactly those found by comparing
all pairs.

The upper levels are built by Spark: a node with more than ``LEAF`` vectors is divided among
centres drawn by a hash, until none has more, and pairs of nodes are expanded level by
level while their bounds allow a link. The vectors of each pair of leaves that is left, less
those too far from the other leaf, meet in one task, which builds the lower levels. Where
nothing can be ruled out, a vector is sent once per leaf of its space, so leaves grow with
their space, up to a bound, and vectors are sent as given, not in double precision. Equal
vectors are one vector with a number.
"""

from __future__ import annotations

from collections.abc import Iterator
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from saldoflow.functions import scalars as S
from saldoflow.llm.components import components, cut, local_roots
from saldoflow.session import settle

#: Vectors under a node that a task takes as they are, in a space of few vectors.
LEAF = 1024
#: In larger spaces a leaf takes this part of the vectors, up to so many (two leaves of 64
#: components, as given and at length one, are then some 70 MB in double precision).
LEAF_PART, LEAF_MOST = 4, 32_768
#: Centres tried at a time when a node is divided, and the bound below which they are not.
CENTRES, FINE = 64, 1e-4
#: Vectors a node's children hold on average at most when its pairs are compared as products,
#: and pairs of one product.
FLAT, PRODUCT = 16, 1 << 20
#: Levels of division at most; what is larger then is dealt out by a hash.
LEVELS = 12
#: Children a node is divided into at most.
FAN = 32
#: Pairs of vectors that a task compares without further levels.
FEW = 4096
#: Pairs of vectors whose components are held at a time.
BLOCK = 1 << 14
#: Distances are rounded by less than this.
SLACK = 1e-6


def valid(vector: Column) -> Column:
    """Whether a vector can link: not null, of one component at least, all finite, not zero."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                                                      & (F.abs(x) < float("inf")))
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


# --- one task ---------------------------------------------------------------------------

class Tree:
    """A cover tree over some vectors: centres, radii and children by node.

    The vectors of a node are a stretch of ``order``. A child's radius is at most half the
    bound of its parent's level; a level that would not divide a node is left out.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        self.square = np.einsum("ij,ij->i", x, x)
        self.centre, self.radius, self.first, self.last, self.children = [], [], [], [], []
        self.order = np.zeros(0, np.int64)
        order: list[np.ndarray] = []
        placed = 0
        members = np.arange(len(x))
        d = np.linalg.norm(x - x[0], axis=1)
        root = self._add(0, float(d.max()))
        # Depth first, so that the vectors below a node are next to each other.
        stack = [(root, members, float(d.max()), False)]
        while stack:
            node, members, bound, done = stack.pop()
            if done:
                self.last[node] = placed
                continue
            self.first[node] = placed
            stack.append((node, members, bound, True))
            if len(members) == 1 or self.radius[node] == 0:
                order.append(members)
                placed += len(members)
                continue
            while bound / 2 >= self.radius[node]:
                bound /= 2
            bound /= 2
            # The node's own centre comes first; each next centre is beyond all before.
            for centre, near in self._spread(members, self.centre[node], bound):
                child = self._add(int(centre), float(np.linalg.norm(x[near] - x[centre], axis=1).max()))
                self.children[node].append(child)
                stack.append((child, near, bound, False))
        self.order = np.concatenate(order)
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)
        self.first, self.last = np.array(self.first), np.array(self.last)
        #: Nodes whose children hold few vectors each, so that comparing by children saves nothing.
        self.flat = np.array(list(map(len, self.children))) * FLAT >= self.last - self.first

    def _spread(self, left: np.ndarray, own: int, bound: float) -> Iterator[tuple[int, np.ndarray]]:
        """Centres further apart than ``bound`` (but for rounding), each with the members that
        are near it and near none before; the radius measured later holds whatever is rounded.

        The distances to the next centres that may come are worked out at a time, as products;
        where a product would round too much, one by one.
        """
        x = self.x
        left = np.concatenate([[own], left[left != own]])
        while len(left):
            draw = left[:CENTRES if bound > FINE else 1]
            if bound > FINE:
                d = self.square[draw][:, None] + self.square[left] - 2 * (x[draw] @ x[left].T)
                near = d <= bound * bound
                near[np.arange(len(draw)), np.arange(len(draw))] = True
            else:
                near = np.linalg.norm(x[left] - x[own], axis=1)[None] <= bound
            free = np.ones(len(left), bool)
            for k, centre in enumerate(draw):
                if free[k]:
                    mine = near[k] & free
                    free &= ~mine
                    yield int(centre), left[mine]
            left = left[free]
            own = left[0] if len(left) else own

    def _add(self, centre: int, radius: float) -> int:
        for part, value in ((self.centre, centre), (self.radius, radius), (self.first, 0), (self.last, 0),
                            (self.children, [])):
            part.append(value)
        return len(self.centre) - 1


def _blocks(n: int) -> Iterator[slice]:
    """Stretches of pairs that are worked on at a time, which bounds a task's memory."""
    return (slice(k, k + BLOCK) for k in range(0, n, BLOCK))


def dual(a: Tree, b: Tree, raw_a: np.ndarray, raw_b: np.ndarray, cosine: float, same: bool):
    """Links between the vectors of two trees (of one with itself if ``same``).

    Returns index arrays (i, j) of linked pairs, i < j if same. raw_*: the vectors as given.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    size_a, size_b = np.linalg.norm(raw_a, axis=1), np.linalg.norm(raw_b, axis=1)
    first, second = [], []

    def compare(i: np.ndarray, j: np.ndarray) -> None:
        for s in _blocks(len(i)):
            c = np.einsum("ij,ij->i", raw_a[i[s]], raw_b[j[s]]) / (size_a[i[s]] * size_b[j[s]])
            hit = c >= cosine
            first.append(i[s][hit])
            second.append(j[s][hit])

    def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return np.concatenate([np.linalg.norm(a.x[a.centre[p[s]]] - b.x[b.centre[q[s]]], axis=1)
                               for s in _blocks(len(p))])

    nodes_a, nodes_b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(nodes_a):
        d = apart(nodes_a, nodes_b)
        both = a.radius[nodes_a] + b.radius[nodes_b]
        near = d <= both + reach + SLACK
        nodes_a, nodes_b, d, both = nodes_a[near], nodes_b[near], d[near], both[near]
        # Few enough pairs of vectors below, or all within reach: no further levels.
        count = (a.last[nodes_a] - a.first[nodes_a]) * (b.last[nodes_b] - b.first[nodes_b])
        one = count == 1
        i, j = a.order[a.first[nodes_a[one]]], b.order[b.first[nodes_b[one]]]
        if same:
            i, j = i[i != j], j[i != j]
        compare(i, j)
        nodes_a, nodes_b, d, both, count = nodes_a[~one], nodes_b[~one], d[~one], both[~one], count[~one]
        wide = b.radius[nodes_b] > a.radius[nodes_a]
        flat = np.where(wide, b.flat[nodes_b], a.flat[nodes_a])
        end = (count <= FEW) | (d + both <= reach - SLACK) | (both == 0) | flat
        for p, q in zip(nodes_a[end], nodes_b[end]):
            all_i = a.order[a.first[p]:a.last[p]]
            j = b.order[b.first[q]:b.last[q]]
            rows = max(1, PRODUCT // len(j))
            for s in range(0, len(all_i), rows):
                i = all_i[s:s + rows]
                # Pairs that the product shows to be too far apart, beyond its rounding, are left out.
                at = np.nonzero(a.x[i] @ b.x[j].T >= cosine - SLACK)
                left, right = i[at[0]], j[at[1]]
                if same and p == q:
                    keep = left < right
                    left, right = left[keep], right[keep]
                if len(left):
                    compare(left, right)
        next_a, next_b = [], []
        for p, q in zip(nodes_a[~end].tolist(), nodes_b[~end].tolist()):
            wide = b.radius[q] > a.radius[p]
            left = a.children[p] if not wide and a.children[p] else [p]
            right = b.children[q] if wide and b.children[q] else [q]
            if same and p == q:
                left = right = a.children[p]
            next_a.append(np.repeat(left, len(right)))
            next_b.append(np.tile(right, len(left)))
            if same and p == q:
                keep = next_a[-1] <= next_b[-1]
                next_a[-1], next_b[-1] = next_a[-1][keep], next_b[-1][keep]
        nodes_a = np.concatenate(next_a) if next_a else np.zeros(0, np.int64)
        nodes_b = np.concatenate(next_b) if next_b else np.zeros(0, np.int64)
    none = np.zeros(0, np.int64)
    i, j = (np.concatenate(first), np.concatenate(second)) if first else (none, none)
    if same:
        i, j = np.minimum(i, j), np.maximum(i, j)
    return i, j


# --- on Spark ---------------------------------------------------------------------------

def _spaces(vectors: DataFrame) -> DataFrame:
    """Equal vectors as one: (key, id, n, embedding, unit); id is the smallest among them."""
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    one = (vectors.filter(valid(F.col("embedding")) & F.col("label").isNotNull())
           .groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")))
    one = one.select(F.col("label").alias("space_label"), F.size("embedding").alias("space_size"), "id", "n", "embedding")
    # Each step once per vector, not again for every component that the next one reads.
    one = S.once(one, raw=F.transform("embedding", lambda x: x.cast("double")))
    one = S.once(one, largest=F.array_max(F.transform("raw", lambda x: F.abs(x))))
    one = S.once(one, scaled=F.transform("raw", lambda x: x / F.col("largest")))
    one = S.once(one, norm=F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x)))
    return one.withColumn("unit", F.transform("scaled", lambda x: x / F.col("norm"))).drop("raw", "largest", "scaled", "norm")


def leaf_size(held: Column, leaf: int) -> Column:
    """Vectors of a leaf in a space of ``held``: a part of them, so that the leaves of a space
    and with them the times a vector is sent do not grow with it, within bounds."""
    return F.greatest(F.lit(leaf), F.least(F.lit(LEAF_MOST), F.ceil(held / LEAF_PART)))


def _raw(given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors scaled by their largest component, as in :func:`_spaces`, and to length one."""
    raw = given.astype(np.float64)
    raw /= np.abs(raw).max(axis=1, keepdims=True)
    return raw, raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _divide(items: DataFrame, leaf: int) -> DataFrame:
    """Add ``node``, an array of the centres' numbers from the root down, and ``path`` of
    nodes passed; no node in the end has more than ``leaf`` items."""
    items = items.withColumn("node", F.concat_ws(",", F.col("space_label").cast("string"), F.col("space_size")))
    sizes = cut(items.groupBy("space").agg(F.count("*").alias("_all")).select("space", leaf_size(F.col("_all"), leaf).alias("most")))
    held = lambda: (items.groupBy("space", "node").agg(F.count("*").alias("held"))
                    .join(sizes, "space").filter(F.col("held") > F.col("most")).select("node", "held", "most"))
    for level in range(LEVELS):
        full = cut(held())
        if full.isEmpty():
            return items
        fan = F.least(F.lit(FAN), F.ceil(2 * F.col("held") / F.col("most")))
        # About ``fan`` items of each full node by a hash: the next level's centres.
        drawn = F.pmod(F.xxhash64(F.lit(level), "item"), F.col("held")) < fan
        centres = settle(items.join(full, "node").filter(drawn).groupBy("node").agg(
            F.sort_array(F.collect_list(F.struct("item", "unit"))).alias("centres")).select(
            "node", F.transform("centres", lambda c: c["unit"]).alias("centres")), "centres")
        kind = items.schema

        def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                node = frame["node"].to_numpy(object, copy=True)
                for at, rows in frame.groupby("node").indices.items():
                    centres = frame["centres"].iloc[rows[0]]
                    if centres is not None and len(centres) > 1:
                        c = np.stack(list(centres))
                        x = np.stack(list(frame["unit"].iloc[rows]))
                        best = np.argmax(x @ c.T, axis=1)
                        node[rows] = [f"{at}.{k}" for k in best]
                yield frame.drop(columns="centres").assign(node=node)[kind.names]

        items = settle(items.join(centres, "node", "left").mapInPandas(nearest, kind), "divided")
    # Vectors too much alike to be divided: dealt out by a hash, all parts meet each other.
    over = settle(held(), "alike")
    part = F.pmod(F.xxhash64(F.lit(LEVELS), "item"), F.ceil(F.col("held") / F.col("most")))
    return items.join(over, "node", "left").withColumn("node", F.when(
        F.col("held").isNotNull(), F.concat_ws(".", "node", part)).otherwise(F.col("node"))).drop("held", "most")


def _nodes(items: DataFrame) -> DataFrame:
    """(space, node, level, leaf, centre, radius) of every node above and at the leaves."""
    parts = F.split("node", "[.]")
    above = items.select("space", "item", "unit", F.col("node").alias("leaf_node"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "."))).alias("node"))
    centres = cut(above.groupBy("space", "node").agg(F.min_by("unit", "item").alias("centre")))
    radii = above.join(centres, ["space", "node"]).groupBy("space", "node").agg(
        F.max(distance(F.col("unit"), F.col("centre"))).alias("radius"), F.max(F.col("leaf_node") == F.col("node")).alias("leaf"))
    return settle(radii.join(centres, ["space", "node"]).withColumn("level", F.size(F.split("node", "[.]"))), "nodes")


def _leaf_pairs(nodes: DataFrame, reach: float) -> DataFrame:
    """(a, b) pairs of leaves, a <= b, that the bounds of no level rule out."""
    root = nodes.filter("level = 1").select("space", F.col("node").alias("a"), F.col("node").alias("b"), "leaf")
    found, now = root.filter("leaf").select("space", "a", "b"), root.filter("NOT leaf")
    inner = nodes.select("space", "node", "level", "leaf", "centre", "radius", F.array_join(
        F.slice(F.split("node", "[.]"), F.lit(1), F.col("level") - 1), ".").alias("parent"))
    # A leaf stays as it is while the other side goes on.
    below = inner.filter("level > 1").unionByName(inner.filter("leaf").withColumn("parent", F.col("node")))
    side = lambda n: below.select("space", F.col("parent").alias(n), *[
        F.col(c).alias(f"{n}_{c}") for c in ("node", "leaf", "centre", "radius")])
    while not now.isEmpty():
        pairs = now.select("space", "a", "b").join(side("a"), ["space", "a"]).join(side("b"), ["space", "b"])
        near = distance(F.col("a_centre"), F.col("b_centre")) <= F.col("a_radius") + F.col("b_radius") + reach + SLACK
        next_ = cut(pairs.filter(near & ((F.col("a") != F.col("b")) | (F.col("a_node") <= F.col("b_node")))).select(
            "space", F.col("a_node").alias("a"), F.col("b_node").alias("b"), (F.col("a_leaf") & F.col("b_leaf")).alias("leaf")))
        found = found.unionByName(next_.filter("leaf").select("space", "a", "b"))
        now = next_.filter("NOT leaf")
    return found


def links(items: DataFrame, cosine: float, leaf: int = LEAF) -> DataFrame:
    """(item, root, linked): for each item and task in which it has links, the smallest item
    it reaches there and the number of vectors it links with there."""
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    divided = _divide(items, leaf)
    nodes = _nodes(divided)
    leaves = nodes.filter("leaf").select("space", "node", "centre", "radius")
    pairs = _leaf_pairs(nodes, reach).select("space", "a", "b")
    sides = pairs.select("space", "a", "b", F.col("a").alias("node"), F.col("b").alias("other"), F.lit(0).alias("side")).unionByName(
        pairs.filter("a != b").select("space", "a", "b", F.col("b").alias("node"), F.col("a").alias("other"), F.lit(1).alias("side")))
    sides = settle(sides.join(leaves.select("space", F.col("node").alias("other"), "centre", "radius"), ["space", "other"])
                   .drop("other"), "sides")
    # Of the pair's other leaf, only what is near enough to link is passed on.
    meet = divided.join(sides, ["space", "node"]).filter(
        (F.col("a") == F.col("b")) | (distance(F.col("unit"), F.col("centre")) <= F.col("radius") + reach + SLACK)).select(
        "space", "a", "b", "side", "item", "n", "embedding")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["side", "item"], kind="stable")
        left, right = frame[frame.side == 0], frame[frame.side == 1]
        stack = lambda f: _raw(np.stack(list(f["embedding"].to_numpy())))
        same = frame["a"].iloc[0] == frame["b"].iloc[0]
        item, n = frame["item"].to_numpy(), frame["n"].to_numpy()
        i = j = np.zeros(0, np.int64)
        if same or (len(left) and len(right)):
            raw, unit = stack(left)
            a = Tree(unit)
            if same:
                i, j = dual(a, a, raw, raw, cosine, True)
            else:
                other, unit = stack(right)
                i, j = dual(a, Tree(unit), raw, other, cosine, False)
                j = j + len(left)
        linked = np.bincount(i, n[j], len(item)) + np.bincount(j, n[i], len(item))
        # The smallest item comes first, as items are sorted by value.
        by_item = np.argsort(item, kind="stable")
        rank = np.empty_like(by_item)
        rank[by_item] = np.arange(len(item))
        root = local_roots(len(item), rank[i], rank[j])
        some = np.flatnonzero(linked > 0)
        return pd.DataFrame({"item": item[some], "root": item[by_item[root[rank[some]]]],
                             "linked": linked[some].astype(np.int64)})

    return meet.groupBy("space", "a", "b").applyInPandas(compare, "item long, root long, linked long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, leaf: int = LEAF) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors link when their labels are equal and not null and their cosine, in double
    precision, is at least ``cosine``. Vectors that are null, empty, zero or hold a null or
    non-finite component, or a null label, link with nothing; vectors of different lengths do
    not link. Rows that repeat a vec_id are vectors of their own, each with a row. A vector
    without links is its own component. Further columns are not read.
    """
    given = vectors.select("vec_id", "embedding", "label")
    classes = _spaces(given)
    # A class's number is the hash of its content, which also distinguishes rows that repeat an id.
    classes = settle(classes.withColumn("item", F.xxhash64("space_label", "embedding")).withColumn(
        "space", F.concat_ws(",", F.col("space_label").cast("string"), F.col("space_size").cast("string"))), "vectors")
    items = classes.select("space", "space_label", "space_size", "item", "n", "embedding", "unit")
    found = cut(links(items, cosine, leaf))
    linked = found.groupBy("item").agg(F.sum("linked").alias("linked"))
    parts = components(found, "item", "root").withColumnRenamed("node", "part_item")
    named = classes.select("item", "id", "n").join(linked, "item", "left").join(
        parts, F.col("item") == F.col("part_item"), "left").select(
        "item", "id", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "item").alias("component"))
    smallest = cut(named.groupBy("component").agg(F.min("id").alias("component_id")))
    labels = cut(named.join(smallest, "component").select("item", "n_links", "component_id"))
    item = F.when(valid(F.col("embedding")) & F.col("label").isNotNull(), F.xxhash64("label", "embedding"))
    rows = given.select("vec_id", item.alias("item")).join(labels, "item", "left")
    component = F.when(F.col("item").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
