"""N-gram Jaccard join with R-trees over count vectors.

A document is the set of its five-word shingles, hashed to 64 bits; documents of the same set are one node. Nodes that
can be similar share a shingle among the first few of their sets in one common order (rare ones first, by a sketch of
how many documents hold each). Shingles are hashed into groups, and a node's counts per group are its point. The overlap
of two sets is at most the sum of the smaller counts. Pairs that share a shingle few nodes have, and that this bound
leaves, and all nodes of other shared shingles are joined to clusters that no link crosses: in a long input nearly every
node shares some shingle with another, and without the bound they would all hang together. In a cluster points form an
R-tree, with at most the sum over the upper corner as bound of a box. Pairs that it leaves split the clusters further;
only then are whole sets moved, and the pairs that the tree leaves verified.

Clusters are worked on in chunks of bounded size. A chunk returns a spanning forest of its pairs, never all of them. In
a cluster of many chunks, pairs of chunks are compared only where sizes allow a link and labels differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.llm import common
from opinara.llm.components import components
from opinara.llm.packing import Hashes, pack, pack_sorted, split_two, two, unpack, unpack_sorted
from opinara.session import stored

# Fixed values of the query contract.
WORDS = 5
PERCENT = 80
# Groups of shingles, entries of a box, documents of a chunk; characters hashed together, shingles of a block, bytes of
# text per shard.
GROUP_BITS = 8
GROUPS = 1 << GROUP_BITS
FANOUT = 16
CHUNK = 2_000
GROUP_CHARS = 1_000_000
BLOCK_SHINGLES = 500_000
SHARD_BYTES = 16_000_000
# Cells of the sketch (a byte each, sent to all tasks) and the parts it is added up in. Links do not depend on the
# order of shingles, only the number of candidates does.
CELL_BITS, PART_BITS = 24, 6
# Nodes that share a shingle and are looked at in pairs; more of them are joined as they are. Links do not depend on it.
PAIRED = 16
# Pairs of points unpacked at once.
SLICE_PAIRS = 2_000
# Nodes whose ids may be sent to all tasks; more are joined.
BROADCAST_NODES = 500_000

MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(31)) * MIX
    return values ^ values >> np.uint64(29)


def shingle_sets(texts: list[str], hashes: Hashes, words: int = WORDS) -> list[np.ndarray]:
    """Sorted hashes of each text's different shingles; a shorter text is one shingle, one without words has none."""
    hashes.trim()
    rows = [text.encode(errors="replace").lower().split() for text in texts]
    sizes = np.array(list(map(len, rows)), dtype=np.int64)
    flat = np.fromiter(map(hashes.__getitem__, chain.from_iterable(rows)), dtype=np.uint64, count=int(sizes.sum()))
    del rows
    ends = np.cumsum(sizes)
    value = np.full(max(len(flat) - words + 1, 0), words, dtype=np.uint64)
    for k in range(words):
        value = mixed(value + flat[k : len(flat) - words + 1 + k])
    found = []
    for start, end in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        if end - start >= words:
            found.append(np.unique(value[start : end - words + 1]))
        else:
            short = np.full(min(end - start, 1), end - start, dtype=np.uint64)
            for k in range(start, end):
                short = mixed(short + flat[k : k + 1])
            found.append(short)
    return found


def groups_of(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups that fit in memory beside their hashes."""
    start = chars = 0
    for end, text in enumerate(texts):
        chars += len(text)
        if chars >= GROUP_CHARS:
            yield texts[start : end + 1]
            start, chars = end + 1, 0
    if start < len(texts):
        yield texts[start:]


def node_of(found: np.ndarray) -> int:
    """A signed 64-bit id of a set."""
    return xxhash.xxh3_64_intdigest(found.tobytes(), seed=len(found)) - (1 << 63)


def least_overlap(a: np.ndarray | int, b: np.ndarray | int):
    """Fewest common shingles of two linked sets of these sizes."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def prefix(found: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the common order, of which two linked sets always share one.

    The order is by the sketch's cell of a shingle, then by its hash.
    """
    size = len(found) - -(-PERCENT * len(found) // 100) + 1
    return found[np.argsort(sketch[cell_of(found)], kind="stable")[:size]]


def cell_of(found: np.ndarray) -> np.ndarray:
    return found >> np.uint64(64 - CELL_BITS)


NODES = "n_shingles long, node long, counts binary"
SKETCH = "_part int, _counts binary"


def with_sets(docs: DataFrame, text: str = "_text") -> DataFrame:
    """``docs`` without ``text`` but with n_shingles, node (null without words) and group counts; then parts of the sketch.

    Rows with ``_part`` are no documents: they have counts of the task's different sets for a part of the cells.
    """
    fields = [f for f in docs.schema.fields if f.name != text]
    hashes = Hashes()
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), NODES, SKETCH])
    names = [*(f.name for f in fields), "n_shingles", "node", "counts", "_part", "_counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELL_BITS, dtype=np.uint16)
        kinds = []
        for batch in batches:
            kinds = [batch.column(f.name).type for f in fields]
            sizes, nodes, points, held = [], [], [], {}
            for group in groups_of(batch.column(text).to_pylist()):
                sets = shingle_sets(group, hashes)
                own = [node_of(s) if len(s) else None for s in sets]
                held.update(zip(own, sets, strict=True))
                nodes += own
                sizes += map(len, sets)
                points += map(packed_counts, sets)
                add_cells(counts, list(held.values()))
                held = dict.fromkeys(held, np.empty(0, np.uint64))
            none = [pa.nulls(len(nodes), pa.int32()), pa.nulls(len(nodes), pa.binary())]
            made = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(points, pa.binary())]
            columns = [*(batch.column(f.name) for f in fields), *made]
            yield pa.RecordBatch.from_arrays([*columns, *none], names)
        pa.default_memory_pool().release_unused()
        if kinds:
            parts = counts.reshape(1 << PART_BITS, -1)
            full = np.flatnonzero(parts.any(axis=1)).tolist()
            empty = [pa.nulls(len(full), kind) for kind in (*kinds, pa.int64(), pa.int64(), pa.binary())]
            own = [pa.array(full, pa.int32()), pa.array([pack(parts[n]) for n in full], pa.binary())]
            yield pa.RecordBatch.from_arrays([*empty, *own], names)

    return docs.mapInArrow(run, schema)


def group_counts(found: np.ndarray) -> np.ndarray:
    return np.bincount((found >> np.uint64(64 - GROUP_BITS)).astype(np.int64), minlength=GROUPS)


def packed_counts(found: np.ndarray) -> bytes | None:
    """A set's point: how many of its shingles fall in each group."""
    if not len(found):
        return None
    counts = group_counts(found)
    return pack(counts.astype(np.uint8 if counts.max() < 256 else np.uint32))


def add_cells(counts: np.ndarray, sets: list[np.ndarray]) -> None:
    cells = np.sort(cell_of(np.concatenate(sets)).astype(np.uint32)) if sets else np.empty(0, np.uint32)
    if len(cells):
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        held = counts[cells[starts]] + np.diff(np.append(starts, len(cells)))
        counts[cells[starts]] = np.minimum(held, 0xFFFF)


def sketch_of(rows: DataFrame) -> np.ndarray:
    """A byte for each cell that grows with the number of sets it counts; 2 ** CELL_BITS bytes for any input."""

    def add(group: pa.Table) -> pa.Table:
        total = sum(unpack(body.as_py()).astype(np.int64) for body in group.column("_counts"))
        code = np.minimum(np.rint(8 * np.log2(1 + total)), 255).astype(np.uint8)
        return pa.table({"_part": group.column("_part")[:1], "_counts": pa.array([pack(code)], pa.binary())})

    parts = rows.where("_part IS NOT NULL").select("_part", "_counts").groupBy("_part").applyInArrow(add, SKETCH)
    sketch = np.zeros((1 << PART_BITS, 1 << (CELL_BITS - PART_BITS)), dtype=np.uint8)
    for row in parts.collect():
        sketch[row["_part"]] = unpack(bytes(row["_counts"]))
    return sketch.ravel()


def stars(keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different (key, node) with the node's size in order of key, and links as rows of (a, b).

    A key of more than PAIRED nodes, or of one of size 0, becomes one row of its least node with size 0 and links from
    that to its other nodes.
    """
    order = np.lexsort((sizes, nodes, keys))
    keys, nodes, sizes = keys[order], nodes[order], sizes[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes, sizes = keys[first], nodes[first], sizes[first]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    if not len(starts):
        return keys, nodes, sizes, np.empty((0, 2), np.int64)
    held = np.diff(np.append(starts, len(keys)))
    many = (held > PAIRED) | (np.minimum.reduceat(sizes, starts) == 0)
    inside = np.repeat(many, held)
    center = np.repeat(nodes[starts], held)
    links = np.unique(np.stack([center, nodes], axis=1)[inside & ~new], axis=0)
    kept = new | ~inside
    return keys[kept], nodes[kept], np.where(inside, 0, sizes)[kept], links


def pairs_by_key(keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Pairs (a, b) of nodes of the same key, whose sizes allow a link, as different rows; keys are in order."""
    pairs = [np.empty((0, 2), np.int64)]
    for ahead in range(1, PAIRED):
        at = np.flatnonzero(keys[ahead:] == keys[:-ahead])
        if not len(at):
            break
        a, b = sizes[at], sizes[at + ahead]
        at = at[100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)]
        pairs.append(np.unique(np.stack([nodes[at], nodes[at + ahead]], axis=1), axis=0))
    return np.unique(np.concatenate(pairs), axis=0)


def candidate_links(docs: DataFrame, sketch: np.ndarray, shards: int) -> DataFrame:
    """(a, b, open): pairs of nodes that share a shingle of their prefixes, or links that join all nodes which share one.

    The nodes of a shingle are paired (``open``) while they are few, and else joined by a star. A block of documents makes
    its own stars and sends only their centers on. Pairs whose sizes allow no link are left out.
    """
    order = docs.sparkSession.sparkContext.broadcast(sketch)
    hashes = Hashes()

    def message(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        columns = [
            pa.array([r[0] for r in rows], pa.int32()),
            pa.array([r[1] for r in rows], pa.binary()),
            pa.array([r[2] for r in rows], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["shard", "keys", "links"])

    def closed(sets: dict[int, tuple[int, np.ndarray]]) -> pa.RecordBatch:
        fronts = [front for _, front in sets.values()]
        spans = [len(f) for f in fronts]
        nodes = np.repeat(np.array(list(sets), dtype=np.int64), spans)
        sizes = np.repeat(np.array([size for size, _ in sets.values()], dtype=np.uint32), spans)
        keys, nodes, sizes, links = stars(np.concatenate(fronts), nodes, sizes)
        shard = (keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
        bounds = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64)).tolist()
        rows = []
        for number in np.unique(shard).astype(np.int64).tolist():
            a, b = bounds[number], bounds[number + 1]
            rows.append((number, two(pack_sorted(keys[a:b]), two(pack(nodes[a:b]), pack(sizes[a:b]))), b""))
        return message([*rows, (int(nodes[0]) % shards, b"", pack(links.ravel()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, tuple[int, np.ndarray]] = {}
        size = 0
        for batch in batches:
            for group in groups_of(batch.column("_text").to_pylist()):
                for found in shingle_sets(group, hashes):
                    if len(found):
                        front = prefix(found, order.value)
                        sets[node_of(found)] = len(found), front
                        size += len(front)
                if size >= BLOCK_SHINGLES:
                    yield closed(sets)
                    sets, size = {}, 0
        if sets:
            yield closed(sets)

    def gather(group: pa.Table) -> pa.Table:
        keys, nodes, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
        links = [np.empty((0, 2), np.int64)]
        for packed, own in zip(group.column("keys").to_pylist(), group.column("links").to_pylist(), strict=True):
            if own:
                links.append(unpack(own).reshape(-1, 2))
            else:
                a, rest = split_two(packed)
                b, c = split_two(rest)
                keys.append(unpack_sorted(a))
                nodes.append(unpack(b))
                sizes.append(unpack(c))
        few, own, size, joined = stars(np.concatenate(keys), np.concatenate(nodes), np.concatenate(sizes))
        links = np.unique(np.concatenate([*links, joined]), axis=0)
        pairs = pairs_by_key(few, own, size.astype(np.int64))
        both = np.concatenate([links, pairs])
        return pa.table({"a": both[:, 0], "b": both[:, 1], "open": np.arange(len(both)) >= len(links)})

    sent = docs.mapInArrow(run, "shard int, keys binary, links binary")
    return sent.groupBy("shard").applyInArrow(gather, "a long, b long, open boolean")


def allowed_by_points(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the bound on the group counts of ``nodes`` (node, body) allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_PAIRS):
                batch = whole.slice(start, SLICE_PAIRS)
                a, b = (np.stack([unpack(x) for x in batch.column(c).to_pylist()]).astype(np.int64) for c in ("_a", "_b"))
                most = np.minimum(a, b).sum(axis=1)
                fits = (100 + PERCENT) * most >= PERCENT * (a.sum(axis=1) + b.sum(axis=1))
                yield batch.select(["a", "b"]).filter(pa.array(fits))

    for end in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(end), F.col("body").alias(f"_{end}")).hint("merge"), end)
    return pairs.select("a", "b", "_a", "_b").mapInArrow(run, "a long, b long")


SETS = "node long, cluster long, chunk long, n_shingles long, body binary"


def candidate_sets(texts: DataFrame, chosen: DataFrame, one_part: bool = True) -> DataFrame:
    """Whole sets of the nodes in ``chosen`` (node, cluster, chunk, _hash, _in), each made from one of its texts.

    With ``one_part`` a node's copies are read only in the part of the scan where it was met first; some nodes are
    missing then if the scan comes in other parts this time.
    """
    texts = texts.withColumns({"_hash": F.xxhash64("_text"), "_in": F.spark_partition_id()})
    wanted = texts.join(chosen, ["_hash", "_in"]) if one_part else texts.drop("_in").join(chosen.drop("_in"), "_hash")
    hashes = Hashes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for batch in batches:
            names = ("node", "cluster", "chunk", "_text")
            rows = {r[0]: r for r in zip(*(batch.column(c).to_pylist() for c in names), strict=True) if r[0] not in met}
            met.update(rows)
            sets = [found for group in groups_of([r[3] for r in rows.values()]) for found in shingle_sets(group, hashes)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([r[n] for r in rows.values()], pa.int64()) for n in range(3)),
                    pa.array(map(len, sets), pa.int64()),
                    pa.array(map(pack_sorted, sets), pa.binary()),
                ],
                ["node", "cluster", "chunk", "n_shingles", "body"],
            )

    return wanted.select("node", "cluster", "chunk", "_text").mapInArrow(run, SETS)


class CountVectorTree:
    """R-tree over the count vectors of sets, packed level by level; boxes keep their upper corner and least size."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        # Neighbours in size, then in the groups that vary most, share a box.
        spread = np.argsort(-vectors.var(axis=0))[:3] if len(vectors) else np.arange(3)
        self.order = np.lexsort((*(vectors[:, g] for g in spread), sizes))
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        self.levels = [(self.vectors, self.sizes)]
        while len(self.levels[-1][1]) > FANOUT:
            upper, least = self.levels[-1]
            starts = np.arange(0, len(least), FANOUT)
            self.levels.append((np.maximum.reduceat(upper, starts), np.minimum.reduceat(least, starts)))

    def near(self, vector: np.ndarray, size: int) -> np.ndarray:
        """Places of all sets that the bound allows to be linked with this one."""
        found = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, least = self.levels[depth]
            most = np.minimum(upper[found], vector).sum(axis=1)
            found = found[(100 + PERCENT) * most >= PERCENT * (size + least[found])]
            if depth:
                below = (found[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                found = below[below < len(self.levels[depth - 1][1])]
        sizes = self.sizes[found]
        fits = (100 * np.minimum(sizes, size) >= PERCENT * np.maximum(sizes, size)) & (sizes > 0)
        return self.order[found[fits]]


def spanning_links(points: np.ndarray, sizes: np.ndarray, labels: list, sides: list, linked) -> list[tuple[int, int]]:
    """A forest of pairs of places that the tree's bound and then ``linked`` allow; equal labels count as joined already.

    ``linked(own, near)`` tells which of the places ``near`` are linked with ``own``. With two sides, only pairs across
    them are looked at.
    """
    across = len(set(sides)) > 1
    side = np.array(sides)
    held = np.flatnonzero(side == 1) if across else np.arange(len(sizes))
    tree = CountVectorTree(points[held], sizes[held])
    root = np.unique(np.array(labels, dtype=np.int64), return_inverse=True)[1]
    links = []
    for own in np.flatnonzero(side == 0).tolist():
        near = held[tree.near(points[own], int(sizes[own]))]
        near = near[root[near] != root[own]]
        if not across:
            near = near[near > own]
        if not len(near):
            continue
        for other in near[linked(own, near)].tolist():
            if root[other] != root[own]:
                links.append((own, other))
                root[root == root[other]] = root[own]
    return links


def pairs_of_points(bodies: list[bytes], labels: list, sides: list) -> list[tuple[int, int]]:
    """Pairs that the bound on group counts allows."""
    points = np.stack([unpack(body) for body in bodies]).astype(np.int64)
    return spanning_links(points, points.sum(axis=1), labels, sides, lambda own, near: np.ones(len(near), dtype=bool))


def pairs_of_sets(bodies: list[bytes], labels: list, sides: list) -> list[tuple[int, int]]:
    """Pairs of linked sets, verified on all their shingles."""
    sets = [unpack_sorted(body) for body in bodies]
    sizes = np.array([len(s) for s in sets])
    whole, place = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(len(whole), dtype=bool)

    def linked(own: int, near: np.ndarray) -> np.ndarray:
        mine = place[bounds[own] : bounds[own + 1]]
        marked[mine] = True
        spans = sizes[near]
        starts = np.concatenate([[0], np.cumsum(spans)[:-1]])
        at = np.repeat(bounds[near] - starts, spans) + np.arange(int(spans.sum()))
        shared = np.add.reduceat(marked[place[at]].astype(np.int64), starts)
        marked[mine] = False
        return 100 * shared >= PERCENT * (spans + sizes[own] - shared)

    return spanning_links(np.stack([group_counts(s) for s in sets]), sizes, labels, sides, linked)


def pairs_among(rows: DataFrame, by: list[str], find) -> DataFrame:
    """Pairs (a, b) that ``find`` gives among the rows (side, node, label, body) of each group; repeated nodes count once."""

    def work(group: pa.Table) -> pa.Table:
        columns = (group.column(c).to_pylist() for c in ("node", "side", "label", "body"))
        rows = {(node, side): (label, body) for node, side, label, body in zip(*columns, strict=True)}
        nodes, sides = [node for node, _ in rows], [side for _, side in rows]
        pairs = find([body for _, body in rows.values()], [label for label, _ in rows.values()], sides)
        ends = [pa.array([nodes[pair[k]] for pair in pairs], pa.int64()) for k in (0, 1)]
        return pa.table({"a": ends[0], "b": ends[1]})

    return rows.groupBy(*by).applyInArrow(work, "a long, b long")


def dealt(nodes: DataFrame, clusters: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``nodes`` with their cluster and chunk, and the clusters that fill many chunks if there are any.

    Small clusters share chunks, large ones are dealt over several of their own.
    """
    clusters = clusters.select("node", F.col("label").alias("cluster"))
    sized = stored(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("_size")), "nj-sizes")
    total, largest = sized.agg(F.sum("_size"), F.max("_size")).first()
    small = F.col("_size") <= CHUNK // 4
    shared = F.pmod(F.xxhash64("cluster"), F.lit(4 * ((total or 0) // CHUNK) + 4))
    own = F.xxhash64("cluster", F.pmod(F.xxhash64("node"), F.ceil(F.col("_size") / CHUNK)))
    placed = clusters.join(sized, "cluster").withColumn("chunk", F.when(small, shared).otherwise(own)).drop("_size")
    many = sized.where(F.col("_size") > CHUNK).select("cluster") if (largest or 0) > CHUNK else None
    return nodes.join(placed.hint("merge"), "node"), many


def all_pairs(rows: DataFrame, many: DataFrame | None, find) -> DataFrame:
    """A spanning forest of the pairs that ``find`` gives inside the clusters of ``rows``; none crosses a cluster."""
    own = rows.withColumns({"side": F.lit(0), "label": F.col("node")})
    pairs = stored(pairs_among(own, ["chunk"], find), "nj-pairs")
    if many is None:
        return pairs
    large = rows.join(F.broadcast(many), "cluster")  # one cluster in CHUNK nodes at most
    return pairs.unionByName(stored(links_across(large, components(pairs), find), "nj-across"))


def set_rows(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """The whole sets of the chosen nodes, stored."""
    count = chosen.count()
    few = F.broadcast(chosen) if count <= BROADCAST_NODES else chosen.hint("merge")
    sets = stored(candidate_sets(texts, few), "nj-sets")
    if sets.select("node").distinct().count() < count:
        sets = stored(candidate_sets(texts, few, one_part=False), "nj-sets")
    return sets


def links_across(rows: DataFrame, joined: DataFrame, find) -> DataFrame:
    """Pairs between nodes of large clusters whose labels differ after the first round.

    Nodes of one large label fill chunks of their own, all others chunks for the rest, each by bands of size; sets that
    are linked lie in the same band or in neighbouring ones.
    """
    labelled = rows.dropDuplicates(["node"]).join(joined, "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    held = labelled.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("_held"))
    labelled = labelled.join(held, ["cluster", "label"])
    band = F.floor(F.ln(F.col("n_shingles")) / F.ln(F.lit(100 / PERCENT)))
    pure = F.when(F.col("_held") >= CHUNK // 4, F.col("label"))
    banded = labelled.withColumns({"band": band, "pure": pure})
    banded = stored(banded.select("cluster", "pure", "band", "node", "label", "body"), "nj-banded")
    counts = banded.groupBy("cluster", "pure", "band").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("parts"))
    key = F.xxhash64("cluster", F.coalesce("pure", F.lit(0)), F.col("pure").isNull(), "band", "part")
    chunks = counts.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    chunks = stored(chunks.withColumn("chunk", key), "nj-chunks")
    other = chunks.select("cluster", *[F.col(c).alias(f"_{c}") for c in ("pure", "band", "chunk")])
    pairs = chunks.join(other, "cluster").where(
        (F.col("chunk") <= F.col("_chunk"))
        & (F.abs(F.col("band") - F.col("_band")) <= 1)
        & ~F.coalesce(F.col("pure") == F.col("_pure"), F.lit(False))
    )
    pairs = stored(pairs.select("chunk", "_chunk").distinct(), "nj-pairs")
    parts = counts.select("cluster", "band", F.col("pure").alias("_pure"), "parts")
    placed = banded.join(parts, ["cluster", "band"]).where(F.col("pure").eqNullSafe(F.col("_pure")))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).withColumn("chunk", key)
    placed = placed.select("chunk", "node", "label", "body")
    left = placed.join(pairs, "chunk").select("chunk", "_chunk", F.lit(0).alias("side"), "node", "label", "body")
    right = placed.withColumnRenamed("chunk", "_chunk").join(pairs.where("chunk != _chunk"), "_chunk")
    right = right.select("chunk", "_chunk", F.lit(1).alias("side"), "node", "label", "body")
    return pairs_among(left.unionByName(right), ["chunk", "_chunk"], find)


def analysed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` without ``_text`` but with n_shingles and node, and (node, label) of all nodes with a link."""
    texts = docs.select("_text")
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    shards = max(4, -(-size // SHARD_BYTES))
    keyed = docs.withColumns({"_hash": F.xxhash64("_text"), "_in": F.spark_partition_id()})
    read = stored(with_sets(keyed), "nj-rows")
    rows = read.where("_part IS NULL").drop("_part", "_counts")
    first = F.min(F.struct("_in", "_hash", "n_shingles", "counts"))
    links = stored(candidate_links(texts, sketch_of(read), shards).distinct(), "nj-links")
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().hint("merge")
    nodes = rows.join(ends, "node", "left_semi").groupBy("node").agg(first.alias("_f"))
    nodes = stored(nodes.select("node", "_f._in", "_f._hash", "_f.n_shingles", F.col("_f.counts").alias("body")), "nj-nodes")
    near = allowed_by_points(links.where("open").select("a", "b"), nodes)
    clusters = components(links.where("NOT open").select("a", "b").unionByName(near))
    points, many = dealt(nodes, clusters)
    clusters = components(all_pairs(points, many, pairs_of_points))
    chosen, many = dealt(nodes.select("node", "_in", "_hash"), clusters)
    links = all_pairs(set_rows(texts, stored(chosen, "nj-chosen")), many, pairs_of_sets)
    return rows.drop("_hash", "_in", "counts"), components(links)


def join(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for each row: component_id is the least id that links reach from it.

    Null and empty texts and texts without a word have no shingles and are linked with nothing; rows of equal sets are
    linked; a null id is never the least unless a component has no other; an empty table gives no rows.
    """
    rows, linked = analysed(docs.select(F.col(id_column).alias("_doc"), common.whole_text(text).alias("_text")))
    labelled = rows.join(linked.hint("merge"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = stored(labelled.select("_doc", "n_shingles", "label"), "nj-labels")
    least = labelled.where("label IS NOT NULL").groupBy("label").agg(F.min("_doc").alias("_least"))
    return labelled.join(least.hint("merge"), "label", "left").select(
        F.col("_doc").alias(id_column), "n_shingles", F.coalesce("_least", "_doc").alias("component_id")
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the least id (null last), then of the least hash of the text.

    Rows without a word are all kept. The columns are those of ``docs``, whatever their names.
    """
    body = common.whole_text(text)
    order = F.struct(F.col(id_column).isNull().alias("last"), F.col(id_column).alias("id"), F.xxhash64(body).alias("hash"))
    key = F.concat_ws(":", F.coalesce(F.col(id_column).cast("string"), F.lit("null")), F.hex(F.xxhash64(body)))
    rows, linked = analysed(docs.select(order.alias("_order"), key.alias("_key"), body.alias("_text")))
    labelled = rows.join(linked.hint("merge"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = labelled.where("label IS NOT NULL").groupBy("label").agg(F.min(F.struct("_order", "_key"))["_key"].alias("_key"))
    wordless = labelled.where("label IS NULL").select("_key", F.lit(True).alias("_all")).distinct()
    kept = stored(first.select("_key", F.lit(False).alias("_all")).unionByName(wordless), "nj-kept")
    chosen = docs.select(F.struct(*docs.columns).alias("_row"), key.alias("_key")).join(kept.hint("merge"), "_key")
    # Of rows that repeat in full, the first one stays.
    before = F.lag(F.lit(1)).over(Window.partitionBy("_key").orderBy("_key"))
    return chosen.withColumn("_before", before).where("_before IS NULL OR _all").select("_row.*")


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return join(common.documents(spark, folder).select("doc_id", "text"))


OP7_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT rid, s
  FROM (SELECT rid, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM worded)),
sizes AS (SELECT rid, count(*) AS n FROM sets GROUP BY rid),
shared AS (SELECT a.rid AS x, b.rid AS y, count(*) AS i FROM sets a JOIN sets b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.rid = x JOIN sizes q ON q.rid = y WHERE 100 * i >= 80 * (p.n + q.n - i)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT rid, rid AS root FROM worded UNION SELECT y, root FROM reached JOIN ways ON x = rid)
SELECT w.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, coalesce(min(o.doc_id), w.doc_id) AS component_id
FROM worded w JOIN reached r ON r.rid = w.rid JOIN worded o ON o.rid = r.root LEFT JOIN sizes z ON z.rid = w.rid
GROUP BY w.rid, w.doc_id
"""
