"""Prefix trie of conversations from vertical bitmaps (operator 13).

A node is a distinct sequence of first turns (role, text); the root has none. Conversations are dealt into shards
of at most ``BLOCK``. Each shard indexes (position, turn) to a bitset of its conversations and walks depth
first: the bitset of a node, intersected with the postings of the next position, gives its children with
their popcounts and the conversations that end there. Nodes have keys made from their turns, so the
shards' nodes are summed up by key.

Figures of whole subtrees need no walk over levels: each node's value is booked on its smallest member at the node's depth, and
each leaf on its smallest member; what a conversation holds from some depth on is a suffix sum, and a node's
subtree is the sum of these over its members.

Defined results: turns are ordered by turn (null first), then by the digest of role and text, so ties and repeated
rows (each a turn of its own) have one order; a null role or text is empty; rows without an id belong to no
conversation and are left out; texts of any length are read whole and only digested; a conversation without turns is
a member of the root and ends there; an empty table gives no rows, not even a root. Other columns, whatever their names,
are ignored.

Scale: a text becomes a 16-byte digest and a word count in the scan. A conversation with a third of all turns is
dealt over tasks: its turns are numbered in range pieces, and it is cut into bands of ``BAND`` turns, which are
the rows of the shards. A band starts at the key of the node above it; only these keys, one for each
whole band, are chained within one task, as a stream. A beginning or a whole conversation shared by a third of all needs no care: shards
are dealt by id, and nodes merge before the shuffle. The ids that end at a node are hashed as a sorted stream of runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, word_array

#: Turns of a conversation in one row of a shard; a root of no text stands at position 0.
BAND = 64
#: Conversations (or bands of them) in a shard, which is the length of the bitsets.
BLOCK = 2048
#: Ids in one run of the end lists.
RUN = 4096
ROOT_TURN = b""
NO_ENDS = hashlib.sha256(b"").hexdigest()
PARTIALS = (
    "node binary, parent binary, depth bigint, words bigint, least bigint, members array<bigint>, ends array<bigint>"
)


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:16]


def _digest(data: Column) -> Column:
    return F.unhex(F.substring(F.sha2(data, 256), 1, 32))


def turn_rows(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, what, words): each turn as the digest of its role and text, with its word count."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    what = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return rows.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv"),
        F.col(turn_col).alias("turn"),
        _digest(what).alias("what"),
        F.size(word_array(text)).cast("bigint").alias("words"),
    )


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` (conv, turn, what, words) with ``pos``, the turn's place in its conversation from 0.

    Range pieces hold a conversation in order; a row's place is that in its piece plus the rows of the
    pieces before. The latter is asked only for conversations that cross pieces, fewer than there are pieces.
    """
    order = ["conv", "turn", "what"]
    narrow = stored(turns, "turns")  # the sampling of the ranges and the dealing read no text
    dealt = narrow.repartitionByRange(*order, F.monotonically_increasing_id())
    pieces = stored(dealt.withColumn("piece", F.spark_partition_id()), "turn-pieces")
    counts = pieces.groupBy("conv", "piece").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("conv").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("conv", "piece", F.sum("n").over(earlier).alias("before")).where(F.col("before") > 0)
    own = F.row_number().over(W.partitionBy("conv", "piece").orderBy("turn", "what"))
    return (
        pieces.withColumn("own", own)
        .join(F.broadcast(before), ["conv", "piece"], "left")
        .select("conv", "what", "words", (F.col("own") - 1 + F.coalesce("before", F.lit(0))).alias("pos"))
    )


def in_sequence(turns: DataFrame) -> DataFrame:
    """(conv, depth, length, what, words) of every turn in place, with a root row (depth 0) for each conversation."""
    placed = stored(numbered(turns), "numbered")
    convs = placed.groupBy("conv").agg(F.count(F.lit(1)).alias("length"))
    return _with_roots(placed.select("conv", (F.col("pos") + 1).alias("depth"), "what", "words"), convs)


def with_borrowed_beginnings(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """As :func:`in_sequence`, but each conversation c begins with turns of conversation ``c - c % group``.

    The first h turns, ``h = crc32(c) % most``, are those of the other conversation (all if it has fewer, none if
    there is none); c's own turns after its first h follow.
    """
    placed = stored(numbered(turns), "numbered")
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most))
    convs = placed.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select(
        "conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("first")
    )
    heads = placed.where((F.col("pos") < most - 1) & (F.col("conv") % group == 0))
    sizes = heads.groupBy(F.col("conv").alias("first")).agg(F.count(F.lit(1)).alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    rest = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = stored(
        convs.join(sizes, "first", "left").select("conv", "first", "h", taken.alias("taken"), (taken + rest).alias("length")),
        "rebuilt",
    )
    borrowed = convs.join(heads.withColumnRenamed("conv", "first"), "first").where("pos < taken")
    own = placed.join(convs, "conv").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv", (F.col("pos") + 1).alias("depth"), "what", "words"]
    return _with_roots(borrowed.select(*columns).unionByName(own.select(*columns)), convs)


def _with_roots(turns: DataFrame, convs: DataFrame) -> DataFrame:
    roots = convs.select(
        "conv", F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT_TURN).alias("what"),
        F.lit(0).cast("bigint").alias("words"), F.col("length").cast("bigint").alias("length"),
    )
    return turns.withColumn("length", F.lit(None).cast("bigint")).unionByName(roots)


def _chain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows (conv, band, digest of the whole band) in order become (conv, next band, key that it starts at)."""
    conv, key = None, b""
    for batch in batches:
        convs, bands, wholes = (c.to_pylist() for c in batch.columns)
        keys = []
        for c, whole in zip(convs, wholes):
            if c != conv:
                conv, key = c, b""
            key = digest(key + whole)
            keys.append(key)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([b + 1 for b in bands], pa.int64()), pa.array(keys, pa.binary())],
            names=["conv", "band", "start"],
        )


def bands(sequence: DataFrame) -> DataFrame:
    """(conv, band, start, ends, turns): bands of conversations, each with the key of the node above it."""
    turn = F.struct("depth", "what", "words")
    cut = stored(
        sequence.groupBy("conv", F.floor(F.col("depth") / BAND).alias("band")).agg(
            F.sort_array(F.collect_list(turn)).alias("turns"), F.max("length").alias("length")
        ),
        "bands",
    )
    full = cut.where(F.size("turns") == BAND)
    whole = F.aggregate("turns", F.lit(b""), lambda acc, t: _digest(F.concat(acc, t["what"])))
    starts = (
        full.select("conv", "band", whole.alias("whole"))
        .repartition("conv")
        .sortWithinPartitions("conv", "band")
        .mapInArrow(_chain_batches, "conv bigint, band bigint, start binary")
    )
    return cut.join(starts, ["conv", "band"], "left").select(
        "conv", "band", F.coalesce("start", F.lit(b"")).alias("start"), "turns"
    )


def ids_of(bits: int, convs: list[int]) -> list[int]:
    out = []
    while bits:
        low = bits & -bits
        out.append(convs[low.bit_length() - 1])
        bits ^= low
    return out


def walk_shard(rows: list[tuple[int, int, bytes, list[tuple[bytes, int]], bool]]) -> Iterator[tuple]:
    """Nodes of one shard: (key, parent's key, depth, words, members, those that end there).

    ``rows``: (conversation, depth of the first turn, key above it, turns (digest, words), whether the last
    turn is the conversation's last).
    """
    postings: dict[tuple[int, bytes], int] = {}
    words: dict[bytes, int] = {}
    starts: dict[tuple[int, bytes], int] = {}
    present: dict[int, int] = {}
    ended: dict[int, int] = {}
    convs = [r[0] for r in rows]
    for i, (_, first, start, turns, ends) in enumerate(rows):
        bit = 1 << i
        starts[first, start] = starts.get((first, start), 0) | bit
        for depth, (what, n) in enumerate(turns, first):
            postings[depth, what] = postings.get((depth, what), 0) | bit
            present[depth] = present.get(depth, 0) | bit
            words[what] = n
        if ends:
            ended[first + len(turns) - 1] = ended.get(first + len(turns) - 1, 0) | bit
    for (first, start), members in starts.items():
        stack = [(members, first, start, b"")]
        while stack:
            above, depth, parent, path = stack.pop()
            left = above & present.get(depth, 0)
            while left:
                lowest = (left & -left).bit_length() - 1
                what = rows[lowest][3][depth - first][0]
                child = above & postings[depth, what]
                left ^= child
                along = digest(path + what)
                key = digest(start + along)
                yield key, parent, depth, words[what], ids_of(child, convs), ids_of(child & ended.get(depth, 0), convs)
                stack.append((child, depth + 1, key, along))


def _walk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), longs, longs]
    names = [c.split()[0] for c in PARTIALS.split(", ")]
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            convs, first, start, ends, whats, counts = (c.to_pylist() for c in part.columns)
            rows = [
                (c, f, s, list(zip(w, n)), e) for c, f, s, e, w, n in zip(convs, first, start, ends, whats, counts)
            ]
            found = [(k, p, d, w, min(m), m, e) for k, p, d, w, m, e in walk_shard(rows)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names=names)


def shard_nodes(cut: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of every shard (``PARTIALS``), from :func:`bands`; alike rows of a task share a shard."""
    last = F.element_at("turns", -1)["depth"]
    rows = cut.join(lengths, "conv").sortWithinPartitions("band", "start", "turns").select(
        "conv", (F.col("band") * BAND).alias("first"), "start", (last == F.col("length")).alias("ends"),
        F.transform("turns", lambda t: t["what"]).alias("what"), F.transform("turns", lambda t: t["words"]).alias("words"),
    )
    return rows.mapInArrow(_walk_batches, PARTIALS)


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: sorted rows (node, id) become runs (node, first id, ids joined by commas)."""
    for batch in batches:
        nodes, ids = (c.to_pylist() for c in batch.columns)
        out, at = [], 0
        while at < len(ids):
            end = at
            while end < len(ids) and end - at < RUN and nodes[end] == nodes[at]:
                end += 1
            out.append((nodes[at], ids[at], ",".join(map(str, ids[at:end]))))
            at = end
        if out:
            kinds = [pa.binary(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["node", "first", "run"])


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: runs in order become (node, hash of its whole end list)."""
    node, sha = None, None
    for batch in batches:
        out = []
        for n, run in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if n != node:
                if sha is not None:
                    out.append((node, sha.hexdigest()))
                node, sha = n, hashlib.sha256(run.encode())
            else:
                sha.update(b"," + run.encode())
        yield _hashes(out)
    if sha is not None:
        yield _hashes([(node, sha.hexdigest())])


def _hashes(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["node", "ends_sha256"]
    )


def end_digests(partials: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes where two conversations or more end."""
    ends = partials.where(F.size("ends") > 0).select("node", "ends")
    ids = ends.join(nodes.where("n_ends > 1").select("node"), "node").select("node", F.explode("ends").alias("id"))
    runs = ids.repartitionByRange("node", "id").sortWithinPartitions("node", "id").mapInArrow(
        _run_batches, "node binary, first bigint, run string"
    )
    ordered = runs.repartition("node").sortWithinPartitions("node", "first")
    return ordered.mapInArrow(_hash_batches, "node binary, ends_sha256 string")


def subtree_sums(partials: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n_leaves, saved_tokens) of the nodes with two members or more."""
    known = nodes.select(
        "node", "n_convs", F.col("least").alias("top"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        (F.col("n_children") == 0).alias("childless"),
    )
    shared = F.col("n_convs") > 1
    mine = F.col("conv") == F.col("top")
    paths = stored(
        partials.select("node", "depth", "members")
        .join(known.where(shared | F.col("childless")), "node")
        .select("node", "depth", "saved", "childless", "top", shared.alias("shared"), F.explode("members").alias("conv"))
        .select(
            "conv", "depth", F.floor(F.col("depth") / BAND).alias("band"), "node", "shared",
            F.when(mine, F.col("saved")).otherwise(0).alias("saved"), (mine & F.col("childless")).cast("bigint").alias("leaf"),
        ),
        "trie-paths",
    )
    within = W.partitionBy("conv", "band").orderBy(F.desc("depth"))
    below = W.partitionBy("conv").orderBy(F.desc("band")).rowsBetween(W.unboundedPreceding, -1)
    totals = paths.groupBy("conv", "band").agg(F.sum("saved").alias("s"), F.sum("leaf").alias("l"))
    later = totals.select(
        "conv", "band", F.sum("s").over(below).alias("later_saved"), F.sum("l").over(below).alias("later_leaves")
    ).where((F.col("later_saved") > 0) | (F.col("later_leaves") > 0))
    suffix = paths.withColumns({"s": F.sum("saved").over(within), "l": F.sum("leaf").over(within)})
    return (
        suffix.where("shared")
        .join(later, ["conv", "band"], "left")
        .groupBy("node")
        .agg(
            F.sum(F.col("l") + F.coalesce("later_leaves", F.lit(0))).alias("n_leaves"),
            F.sum(F.col("s") + F.coalesce("later_saved", F.lit(0))).alias("saved_tokens"),
        )
    )


def trie(sequence: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    ``sequence``: rows of :func:`in_sequence` or :func:`with_borrowed_beginnings`.
    """
    sequence = stored(sequence, "sequence")
    lengths = sequence.where("depth = 0").select("conv", "length")
    partials = stored(shard_nodes(bands(sequence), lengths), "shard-nodes")
    merged = stored(
        partials.groupBy("node", "parent", "depth", "words").agg(
            F.sum(F.size("members")).alias("n_convs"), F.min("least").alias("least"),
            F.sum(F.size("ends")).alias("n_ends"), F.min(F.array_min("ends")).alias("end"),
        ),
        "nodes",
    )
    children = merged.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(
        merged.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint")),
        "nodes-children",
    )
    above = merged.select(F.col("node").alias("parent"), F.col("least").alias("parent_conv_id"))
    ends = (
        F.when(F.col("n_ends") == 0, F.lit(NO_ENDS))
        .when(F.col("n_ends") == 1, F.sha2(F.col("end").cast("string"), 256))
        .otherwise(F.col("ends_sha256"))
    )
    return (
        nodes.join(above, "parent", "left")
        .join(subtree_sums(partials, nodes), "node", "left")
        .join(end_digests(partials, nodes), "node", "left")
        .select(
            F.col("least").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
            F.coalesce("n_leaves", F.lit(1).cast("bigint")).alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0).cast("bigint")).alias("saved_tokens"),
            ends.alias("ends_sha256"),
        )
    )


def prefix_trie(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The trie of conversations as they are."""
    return trie(in_sequence(turn_rows(rows, id_col, turn_col, role_col, text_col)))


#: DuckDB SQL of the contract's query (crc32 spelled out, as DuckDB has none).
ORACLE = """
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
o AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST,
  substr(sha256(strlen(role) || ':' || role || text), 1, 32)) - 1 AS pos FROM t),
k AS (SELECT DISTINCT c, xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')]),
  lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)),
    lambda a, i: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 4 AS h FROM o),
b AS (SELECT k.c, h, (SELECT count(*) FROM o WHERE o.c = k.c - k.c % 20 AND pos < h) AS taken FROM k),
r AS (SELECT b.c, pos + 1 AS depth, role, text FROM b JOIN o ON o.c = b.c - b.c % 20 AND pos < h
  UNION ALL SELECT b.c, pos - h + taken + 1, role, text FROM b JOIN o ON o.c = b.c AND pos >= h
  UNION ALL SELECT c, 0, NULL, '' FROM b),
s AS MATERIALIZED (SELECT c, max(depth) AS last, list([role, text] ORDER BY depth) AS turns FROM r GROUP BY c),
p AS MATERIALIZED (SELECT c, last, d AS depth, md5(to_json(turns[1:d + 1])) AS node,
  md5(to_json(turns[1:d])) AS parent, turns[d + 1][2] AS text
  FROM s, unnest(range(0, last + 1)) AS u(d)),
n AS MATERIALIZED (SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs,
  any_value(len(list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))) AS words,
  coalesce(string_agg(CASE WHEN last = depth THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends FROM p GROUP BY node),
kids AS (SELECT parent, count(*) AS n_children FROM n GROUP BY parent),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * words AS saved FROM n LEFT JOIN kids ON kids.parent = n.node),
sub AS (SELECT a.node, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(v.saved) AS saved_tokens
  FROM v JOIN p x ON x.c = v.conv_id AND x.depth = v.depth JOIN p a ON a.c = x.c AND a.depth <= x.depth GROUP BY a.node)
SELECT v.conv_id, v.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs,
  v.n_children::BIGINT AS n_children, sub.n_leaves::BIGINT AS n_leaves, sub.saved_tokens::BIGINT AS saved_tokens,
  sha256(v.ends) AS ends_sha256
FROM v JOIN sub USING (node) LEFT JOIN n q ON q.node = v.parent
"""
