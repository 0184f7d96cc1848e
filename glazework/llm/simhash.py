"""SimHash near-duplicate groups through segment popcounts (operator 6).

Fingerprint: words of the A-Z-lowered text, ``shingle``-word shingles with
repeats, XXH64 of each (seed 42); a bit is 1 if set in over half the hashes.
Copies of a text, and all texts with one fingerprint, are one node from there on.

Links at ``max_bits`` or fewer differing bits, found by a grid over segment bit counts:
a fingerprint is embedded as the popcounts of its 2-bit segments. The Manhattan
distance of two such vectors is never over the Hamming distance of the
fingerprints, so a pair within 4 bits is within Manhattan distance 4; over three
parts of the vector, it is within 1 in at least one part. In each part a
fingerprint enters the grid cell of its own vector and the cells one step up in one
dimension; any two vectors within Manhattan distance 1 share a cell. Pairs
that meet in a cell are verified exactly on the fingerprints. The
grid is built for the general budget: ``max_bits`` // ``PARTS`` steps in each part.

A cell's links are returned as a spanning forest, so a group of thousands of
near copies gives edges in proportion to its members, not to their pairs.
Components contract the edges in rounds (every vertex joins its smallest
neighbour, paths are shortened by doubling), each written to the shared folder.

Defined results: a null, empty or blank text has fingerprint zero and links like
any other; a repeated row is a copy; a null id is never the smallest id, unless
a group has no other; an empty table gives no rows. Input columns beside id and text
are carried if asked for; result columns replace input columns of their name.

Scale: texts are read once, in the scan's partitions. Cells are dealt by
their hash; a cell with over ``CELL_ROWS`` fingerprints is cut into blocks, and
each pair of blocks is a task's work of its own, so no task holds an unbounded cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SEED = 42
PARTS = ((0, 22), (22, 42), (42, 64))
CELL_ROWS = 4096
#: Hashes whose bits are counted at a time: bounds the memory of a very long text.
CHUNK = 1 << 15
#: Up to this many fingerprints a cell's pairs are compared by shifts of the whole batch.
SMALL_CELL = 48


def fingerprint(raw: bytes | None, shingle: int = 4) -> int:
    """The unsigned 64-bit fingerprint of a text's UTF-8 bytes."""
    words = (raw or b"").lower().split()  # bytes: A-Z and \\x20 \\x09-\\x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = starts + sizes
    last = min(shingle, len(words)) - 1
    begin, end = starts[: len(words) - last].tolist(), ends[last:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(begin), CHUNK):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(begin[k : k + CHUNK], end[k : k + CHUNK])], dtype="<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * ones > len(begin))
    return int(sum(1 << int(b) for b in set_bits))


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(prints.view(np.int64))], names=[*batch.schema.names[:-1], "_fp"]
            )

    return run


def with_fingerprints(docs: DataFrame, columns: list[str], text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``columns`` of ``docs`` and ``_fp`` (the fingerprint as a signed long)."""
    plain = docs.select(*columns, F.col(text_col).cast("binary").alias("_raw"))
    fields = [f for f in plain.schema.fields if f.name != "_raw"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return plain.mapInArrow(_fingerprint_batches(shingle), f"{schema}, _fp bigint")


def grid_cells(prints: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, index of the fingerprint): the cells that each fingerprint enters.

    The vector of a part is packed at two bits a segment; counts are 0 to 2. All
    vectors up to ``budget`` steps up are entered: of two vectors within Manhattan
    distance ``budget``, both reach their element-wise maximum.
    """
    low = np.uint64(0x5555555555555555)
    counts = (prints & low) + ((prints >> np.uint64(1)) & low)
    cells, index = [], []
    every = np.arange(len(prints))
    for part, (begin, end) in enumerate(PARTS):
        mask = np.uint64(((1 << (end - begin)) - 1) << begin)
        level = [(counts & mask, every, begin)]
        for step in range(budget + 1):
            following = []
            for vector, rows, first in level:
                cells.append((vector >> np.uint64(begin)) | np.uint64(part << 62))
                index.append(rows)
                for at in range(first, end, 2) if step < budget else ():
                    room = ((vector >> np.uint64(at)) & np.uint64(3)) < 2
                    following.append((vector[room] + np.uint64(1 << at), rows[room], at))
            level = following
    return np.concatenate(cells), np.concatenate(index)


def _cell_batches(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            if len(prints):
                cells, index = grid_cells(prints, budget)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells.view(np.int64)), pa.array(prints[index].view(np.int64))], names=["cell", "fp"]
                )

    return run


def forest(prints: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges (a, b) that span the components of one cell's distinct fingerprints.

    Breadth first: each reached fingerprint is compared with all that are not yet
    reached, in one vector operation.
    """
    rest, edges = prints, []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= max_bits
            if near.any():
                found = rest[near]
                edges.append((np.full(len(found), at, np.uint64), found))
                queue.extend(found)
                rest = rest[~near]
    return edges


def cell_links(cells: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of every cell; the rows of a cell stand together."""
    starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    sizes = np.diff(np.r_[starts, len(cells)])
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    for s, n in zip(starts[sizes > SMALL_CELL], sizes[sizes > SMALL_CELL]):
        edges += forest(np.unique(prints[s : s + n]), max_bits)
    small = np.repeat(sizes <= SMALL_CELL, sizes)
    at = np.flatnonzero(small)
    for shift in range(1, SMALL_CELL):
        at = at[at + shift < len(cells)]
        at = at[cells[at] == cells[at + shift]]
        if not len(at):
            break
        a, b = prints[at], prints[at + shift]
        near = (np.bitwise_count(a ^ b) <= max_bits) & (a != b)
        if near.any():
            edges.append((a[near], b[near]))
    if not edges:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate([a for a, _ in edges]), np.concatenate([b for _, b in edges])


def _link_batches(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(cells, prints):
            a, b = cell_links(cells, prints, max_bits)
            if len(a):
                lo, hi = np.minimum(a.view(np.int64), b.view(np.int64)), np.maximum(a.view(np.int64), b.view(np.int64))
                both = np.unique(np.stack([lo, hi], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        cells, prints = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = np.r_[cells, batch.column(0).to_numpy(zero_copy_only=False)]
            prints = np.r_[prints, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)]
            whole = int(np.searchsorted(cells != cells[-1], False)) if cells[0] == cells[-1] else int(
                np.flatnonzero(cells != cells[-1])[-1] + 1
            )  # the last cell may go on in the next batch
            if whole:
                yield from emit(cells[:whole], prints[:whole])
                cells, prints = cells[whole:], prints[whole:]
        if len(cells):
            yield from emit(cells, prints)

    return run


def link_fingerprints(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """Edges (a, b) that span the components of distinct fingerprints (column ``_fp``)."""
    budget = max_bits // len(PARTS)
    cells = stored(nodes.select("_fp").mapInArrow(_cell_batches(budget), "cell bigint, fp bigint"), "grid")
    hot = stored(
        cells.groupBy("cell").count().where(F.col("count") > CELL_ROWS).withColumn(
            "blocks", F.ceil(F.col("count") / CELL_ROWS).cast("int")
        ),
        "hot-cells",
    )
    # a hot cell's rows go to each pair of blocks that holds theirs; the others keep their cell
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")),
    )
    dealt = (
        cells.join(hot.select("cell", "blocks"), "cell", "left")
        .select("cell", "fp", F.explode(pairs).alias("pair"))
        .select(F.xxhash64("cell", "pair").alias("unit"), "fp")
        if not hot.isEmpty()
        else cells.withColumnRenamed("cell", "unit")
    )
    return (
        dealt.repartition("unit")
        .sortWithinPartitions("unit")
        .mapInArrow(_link_batches(max_bits), "a bigint, b bigint")
        .distinct()
    )


def tree_roots(up: DataFrame) -> DataFrame:
    """(node, root) pointers, each to a smaller node or itself, replaced by the ends of their paths."""
    while True:
        above = up.select(F.col("node").alias("mid"), F.col("root").alias("top"))
        doubled = stored(
            up.join(above, up["root"] == above["mid"]).select(
                "node", F.col("top").alias("root"), (F.col("top") < F.col("root")).alias("moved")
            ),
            "paths",
        )
        up = doubled.select("node", "root")
        if doubled.where("moved").isEmpty():
            return up


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root the smallest node of its component.

    Contraction: each node points to its smallest neighbour or to itself, pointers are
    doubled until each tells the root of its tree, edges are renamed to roots and loops dropped.
    A node that stayed alone has a smaller neighbour from then on, so the nodes of a
    component halve every two rounds at least, and a round doubles as often as the logarithm of its
    longest path. The roots of each round are written and read off from the last round back.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "joins")
        up = tree_roots(up)
        rounds.append(up)
        left = edges.join(up, edges["a"] == up["node"]).select(F.col("root").alias("ra"), "b")
        right = left.join(up, left["b"] == up["node"]).select("ra", F.col("root").alias("rb"))
        edges = stored(
            right.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            "edges",
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds[-1]
    for up in reversed(rounds[:-1]):
        later = roots.select(F.col("node").alias("mid"), F.col("root").alias("top"))
        roots = stored(
            up.join(later, up["root"] == later["mid"], "left").select("node", F.coalesce("top", "root").alias("root")),
            "roots",
        )
    return roots


def with_roots(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """``nodes`` (distinct fingerprints, column ``_fp``) with ``_root``, the fingerprint that names the group."""
    roots = components(link_fingerprints(nodes, max_bits))
    return nodes.join(roots, nodes["_fp"] == roots["node"], "left").select(
        *(nodes[c] for c in nodes.columns), F.coalesce("root", "_fp").alias("_root")
    )


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4,
    keep: list[str] | None = None,
) -> DataFrame:
    """(id, carried columns, fingerprint, component_id) for every row."""
    carry = [c for c in (keep or []) if c not in (id_col, "fingerprint", "component_id")]
    prints = stored(with_fingerprints(docs, [id_col, *carry], text_col, shingle), "prints")
    nodes = stored(prints.groupBy("_fp").agg(F.min(id_col).alias("_least")), "nodes")
    rooted = with_roots(nodes, max_bits)
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    groups = stored(rooted.join(least, "_root").select("_fp", "component_id"), "groups")
    return prints.join(groups, "_fp").select(
        id_col, *carry, F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
