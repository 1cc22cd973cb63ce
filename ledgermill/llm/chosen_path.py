"""Set similarity join of documents by chosen paths, and the groups it links.

A document's set holds the distinct runs of words of its text. In each of several
independent trees a document follows one path: at every node the tree chooses one
of ``COORDINATES`` minwise hash functions, and the document goes to the child named
by its minwise token there. Two documents of similarity s share a node of depth d
with probability about s ** d. The trees share their coordinates, so the chance of
a pair to meet depends on how many of its coordinates agree, a binomial number;
``trees_needed`` gives the trees that keep ``RECALL`` of the pairs at the threshold.
A document in a large node of the first depth has more trees, as many as nodes of
the last depth need.

A document stops at its first node of at most ``LEAF`` documents, and these small
nodes are compared exhaustively. A node still larger at ``LAST_DEPTH`` holds
documents that are alike; it is cut into parts that all hold its least document,
and what the parts leave unlinked is compared block by block, so no pair is lost
and no pairs of a whole group are ever listed.

Trees are worked off in batches. A node whose documents are already in one group
can add nothing to the groups and is left out, so the full sets, which confirm
every link, are moved about once per document with a likely partner.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.components import components
from ledgermill.llm.ordered import shuffle_tasks
from ledgermill.llm.ragged import distinct_by_text, mixed, shingle_hashes, split_words, text_slices
from ledgermill.sources.paths import stored

COORDINATES = 96
#: Trees of every document, or more if nodes of the first depth need them.
TREES = 12
FIRST_DEPTH, LAST_DEPTH = 2, 6
LEAF = 64
#: Share of the pairs at the threshold that meet in a tree at least.
RECALL = 0.999
#: The first trees of each batch; the first batch joins most groups, the last has the trees of deep nodes.
BATCHES = (0, 1, 3, TREES)
#: Pairs whose minwise tokens agree in less than the threshold minus this are not likely:
#: over four standard deviations of the estimate.
MARGIN = 0.15


def missed(similarity: float, depth: int, trees: int) -> float:
    """The share of pairs of a similarity that meet in none of the trees if all their nodes are of this depth."""
    total = 0.0
    for agree in range(COORDINATES + 1):
        chance = math.comb(COORDINATES, agree) * similarity**agree * (1 - similarity) ** (COORDINATES - agree)
        total += chance * (1 - (agree / COORDINATES) ** depth) ** trees
    return total


def trees_needed(similarity: float, depth: int) -> int:
    """The least number of trees, ``TREES`` at least, that misses no more than 1 - ``RECALL`` of the pairs."""
    trees = TREES
    while missed(similarity, depth, trees) > 1 - RECALL:
        trees += 1
    return trees


def coordinate_seeds() -> tuple[np.ndarray, np.ndarray]:
    numbers = mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return numbers[:COORDINATES], numbers[COORDINATES:] | np.uint64(1)


def minwise(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The least value of each hash function over each non-empty set, cut to 32 bits."""
    flips, factors = coordinate_seeds()
    out = np.zeros((len(bounds) - 1, COORDINATES), np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        starts = bounds[:-1][full]
        for k in range(COORDINATES):
            out[full, k] = (mixed(np.minimum.reduceat((values ^ flips[k]) * factors[k], starts)) >> np.uint64(32)).astype(np.uint32)
    return out


def described(docs: DataFrame, size: int) -> DataFrame:
    """Set size, a 128-bit key equal for equal sets, and minwise tokens of each row."""
    kind = docs.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            values, bounds = distinct_by_text(*shingle_hashes(split_words(part.column("text"), lower=True), size))
            tokens = minwise(values, bounds)
            keys = [xxhash.xxh3_128_digest(values[a:b].tobytes()) for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(keys, pa.binary()),
                    pa.array([row.tobytes() for row in tokens], pa.binary()),
                ],
                names=["id", "n_shingles", "set_key", "tokens"],
            )

    return docs.mapInArrow(work, f"id {kind}, n_shingles bigint, set_key binary, tokens binary")


def set_rows(docs: DataFrame, size: int) -> DataFrame:
    """The full set of each row."""
    kind = docs.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            values, bounds = distinct_by_text(*shingle_hashes(split_words(part.column("text"), lower=True), size))
            bodies = [values[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(bodies, pa.binary())], names=["id", "members"])

    return docs.mapInArrow(work, f"id {kind}, members binary")


def node_keys(tokens: np.ndarray, tree: int, depth: int) -> np.ndarray:
    """The node of each document at a depth of a tree."""
    node = np.full(len(tokens), mixed(np.array([tree + 1], np.uint64))[0], np.uint64)
    rows = np.arange(len(tokens))
    for _ in range(depth):
        choice = (mixed(node + np.uint64(1)) % np.uint64(COORDINATES)).astype(np.int64)
        node = mixed(node ^ (tokens[rows, choice].astype(np.uint64) + np.uint64(0x9E3779B9)) * np.uint64(0xD6E8FEB86659FD93))
    return node.view(np.int64)


def token_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), COORDINATES)


def paths(reps: DataFrame, depths: list[int], trees: list[int]) -> DataFrame:
    """Nodes of each document: one row per tree and depth."""
    kind = reps.schema["rep"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                tokens = token_matrix(part.column("tokens"))
                for tree in trees:
                    for depth in depths:
                        keys = node_keys(tokens, tree, depth)
                        count = part.num_rows
                        yield pa.RecordBatch.from_arrays(
                            [part.column("rep"), pa.array(np.full(count, tree, np.int32)), pa.array(np.full(count, depth, np.int32)), pa.array(keys)],
                            names=["rep", "tree", "depth", "node"],
                        )

    return reps.mapInArrow(work, f"rep {kind}, tree int, depth int, node bigint")


def small_nodes(reps: DataFrame, trees: list[int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The nodes to compare (node, tree, rep), the members of nodes that stay large (node, rep, n), and the
    documents in large nodes of the first depth (rep)."""
    first = stored(paths(reps, [FIRST_DEPTH], trees), "nodes")
    sizes = first.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    shared = stored(first.join(sizes, "node"), "nodes")
    leaves = shared.where(F.col("n") <= LEAF).select("node", "tree", "rep")
    crowd = shared.where(F.col("n") > LEAF)
    deeper = paths(
        reps.join(crowd.select("rep").distinct(), "rep", "left_semi"),
        list(range(FIRST_DEPTH + 1, LAST_DEPTH + 1)),
        trees,
    ).join(crowd.select("rep", "tree"), ["rep", "tree"], "left_semi")
    deep = stored(deeper, "nodes")
    deep_sizes = deep.groupBy("node").agg(F.count("*").alias("n"), F.min("rep").alias("least"))
    sized = stored(deep.join(deep_sizes, "node"), "nodes")
    # The first node on the path that is small enough, else the last.
    stop = F.min(F.when((F.col("n") <= LEAF) | (F.col("depth") == LAST_DEPTH), F.struct("depth", "node", "n", "least"))).alias("s")
    stopped = stored(sized.groupBy("rep", "tree").agg(stop).select("rep", "tree", "s.node", "s.n", "s.least").where(F.col("n") > 1), "nodes")
    large = stopped.where(F.col("n") > LEAF)
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / LEAF))
    cut = large.select(F.xxhash64("node", part).alias("node"), "tree", "rep", "least")
    # Each part also holds the least document of the node.
    with_least = cut.select("node", "tree", "rep").union(cut.select("node", "tree", F.col("least").alias("rep"))).distinct()
    nodes = leaves.union(stopped.where(F.col("n") <= LEAF).select("node", "tree", "rep")).union(with_least)
    return stored(nodes, "leaves"), stored(large.select("node", "rep", "n"), "large-nodes"), crowd.select("rep").distinct()


def all_nodes(reps: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The nodes to compare and the members of large ones, over as many trees as the threshold needs.

    If one document of a pair is in no large node, the pair is compared wherever it
    shares a node of the first depth. Else both have the trees of the last depth.
    """
    base, most = trees_needed(threshold, FIRST_DEPTH), trees_needed(threshold, LAST_DEPTH)
    nodes, large, crowded = small_nodes(reps, list(range(base)))
    crowded = stored(crowded, "crowded")
    if most == base or crowded.isEmpty():
        return nodes, large
    more_nodes, more_large, _ = small_nodes(reps.join(crowded, "rep", "left_semi"), list(range(base, most)))
    return nodes.union(more_nodes), large.union(more_large)


def by_node(rows: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``work`` to the rows of each node; nodes are small, and a task holds one batch of them."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            nodes = batch.column("node").to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(nodes)) + 1).tolist()]
            for a, b in zip(starts, starts[1:], strict=False):
                if (out := work(batch.slice(a, b - a))) is not None:
                    yield out
            held = batch.slice(starts[-1])
        if held is not None and (out := work(held)) is not None:
            yield out

    return rows.repartition(shuffle_tasks(rows), "node").sortWithinPartitions("node").mapInArrow(walk, schema)


def likely(nodes: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """The rows of nodes whose document has a likely partner in the node, by minwise tokens."""
    kind = reps.schema["rep"].dataType.simpleString()
    least = int(np.floor((threshold - MARGIN) * COORDINATES))

    def work(part: pa.RecordBatch) -> pa.RecordBatch | None:
        tokens = token_matrix(part.column("tokens"))
        agree = np.stack([(tokens == row).sum(axis=1) for row in tokens])
        np.fill_diagonal(agree, 0)
        keep = (agree >= least).any(axis=1)
        return part.select(["node", "tree", "rep"]).filter(pa.array(keep)) if keep.any() else None

    rows = nodes.join(reps.select("rep", "tokens"), "rep").select("node", "tree", "rep", "tokens")
    return by_node(rows, work, f"node bigint, tree int, rep {kind}")


def links(rows: DataFrame, threshold: float) -> DataFrame:
    """Links between groups in each node, confirmed on full sets.

    Every pair of documents of different groups is compared until its groups are
    joined, so a node gives at most one link fewer than it has groups.
    """
    kind = rows.schema["rep"].dataType.simpleString()
    percent = round(threshold * 100)

    def work(part: pa.RecordBatch) -> pa.RecordBatch | None:
        names = part.column("rep").to_pylist()
        group = part.column("component").to_pylist()
        if len(set(group)) < 2:
            return None
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("members")]
        found = []
        for i in range(len(names)):
            for j in range(i):
                if group[i] == group[j]:
                    continue
                small, large = sorted((sets[i], sets[j]), key=len)
                if 100 * len(small) < percent * len(large):
                    continue
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                if 100 * both >= percent * (len(small) + len(large) - both):
                    found.append((names[i], names[j]))
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
        if not found:
            return None
        a, b = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, part.column("rep").type), pa.array(b, part.column("rep").type)], names=["a", "b"])

    return by_node(rows, work, f"a {kind}, b {kind}")


def open_nodes(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of nodes that hold documents of more than one group, with their groups."""
    named = nodes.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed_nodes = named.groupBy("node").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    return named.join(mixed_nodes.select("node"), "node", "left_semi")


def merged(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Groups after more links; ``labels`` (rep, component) holds the documents linked so far."""
    ends = found
    for side in ("a", "b"):
        named = labels.select(F.col("rep").alias(side), F.col("component").alias("_c"))
        ends = ends.join(named, side, "left").withColumn(side, F.coalesce("_c", side)).drop("_c")
    # Documents that have not been linked before are their own groups here.
    joined = components(ends).select(F.col("node").alias("_n"), F.col("component").alias("_to"))
    old = labels.join(joined, labels["component"] == joined["_n"], "left").select("rep", F.coalesce("_to", "component").alias("component"))
    new = joined.join(labels.select(F.col("rep").alias("_n")), "_n", "left_anti").select(F.col("_n").alias("rep"), F.col("_to").alias("component"))
    return stored(old.union(new), "groups")


def left_over(large: DataFrame, labels: DataFrame) -> DataFrame:
    """Blocks that compare, in nodes that stayed large, each document outside the main group with all others."""
    named = large.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    sizes = named.groupBy("node", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy("node").agg(F.max(F.struct("size", "component")).alias("m"), F.count("*").alias("groups")).where("groups > 1")
    named = named.join(main.select("node", F.col("m.component").alias("main")), "node")
    others = named.where(F.col("component") != F.col("main"))
    blocks = others.groupBy("node").agg(F.ceil(F.count("*") / LEAF).alias("blocks"))
    rows = named.join(blocks, "node").withColumn("parts", F.ceil(F.col("n") / LEAF))
    part, block = F.pmod(F.xxhash64("rep"), F.col("parts")), F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks"))
    all_rows = rows.select("node", "rep", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    asked = rows.where(F.col("component") != F.col("main")).select(
        "node", "rep", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), block.alias("block")
    )
    return all_rows.union(asked).select(F.xxhash64("node", "part", "block").alias("node"), "rep").distinct()


def near_duplicate_groups(
    docs: DataFrame,
    words_per_shingle: int = 5,
    threshold: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id_column``, n_shingles, component_id and kept of each row.

    Words are lower-cased (A-Z) runs without white space. A text with fewer words
    than a shingle has one shingle of all its words; one without words, empty or
    NULL, has an empty set and links with nothing. Sets of similarity ``threshold``
    or more (in whole hundredths) are linked; ``component_id`` is the least id that
    links lead to and ``kept`` marks its row. Equal sets are one entry of the join.
    A row with a NULL id links with nothing, has no component and is kept. Ids are
    taken to be unique: rows that share an id count as one document, all kept or none.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    facts = stored(described(source, words_per_shingle), "sets")
    usable = facts.where(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    classes = stored(usable.groupBy("set_key").agg(F.min("id").alias("rep"), F.min("tokens").alias("tokens")), "classes")
    nodes, large = all_nodes(classes.select("rep", "tokens"), threshold)
    active = stored(likely(nodes, classes, threshold), "likely")
    involved = active.select("rep").union(large.select("rep")).distinct()
    wanted = source.join(stored(involved.select(F.col("rep").alias("id")), "involved"), "id", "left_semi")
    sets = stored(set_rows(wanted, words_per_shingle).withColumnRenamed("id", "rep").where(F.length("members") > 0), "members")
    labels = classes.limit(0).select("rep", F.col("rep").alias("component"))

    def step(labels: DataFrame, rows: DataFrame) -> DataFrame:
        pairs = stored(links(open_nodes(rows, labels).join(sets, "rep"), threshold), "links")
        return labels if pairs.isEmpty() else merged(labels, pairs)

    for low, high in zip(BATCHES, [*BATCHES[1:], None], strict=True):
        batch = F.col("tree") >= low if high is None else (F.col("tree") >= low) & (F.col("tree") < high)
        labels = step(labels, active.where(batch).select("node", "rep"))
    if not large.isEmpty():
        labels = step(labels, left_over(large, labels))
    named = classes.select("set_key", "rep").join(labels, "rep", "left")
    named = named.select("set_key", F.coalesce("component", "rep").alias("component"))
    joined = facts.select("id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
