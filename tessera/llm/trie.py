"""Prefix trie of conversations (operator 11).

The trie has a node for every distinct sequence of first turns (role, text) of the conversations,
the root included. It tells how much of a training set is shared prefixes.

1. Dictionary. Distinct turns, known by the MD5 of their length-marked role and text, are numbered
   in that order; a conversation becomes its turns' numbers, sorted by (turn, number). Turns that
   hold over a thousandth of all rows (so at most a thousand of them) are looked up by broadcast,
   the others by a merge join in which the rows of the former are spread.
2. Shards. Equal sequences are one row, whatever their number of conversations. Rows are dealt by
   range of the sequences into shards of about ``SHARD`` turns. A shard's first and last sequences
   are compared with its neighbours', one row per shard.
3. A ternary search tree per shard: sequences are inserted median first, then the medians of the
   halves, so its branches stay balanced. One iterative pass from the last node to the first adds up
   members, leaves and savings. A node that also lies in an earlier shard is left out of the counts
   of distinct things (children, leaves, its own word count), so all counts add up over shards.
4. Boundary nodes, those on the paths of a shard's first and last sequences, are merged over shards
   by a 128-bit hash of their path; all others belong to one shard. A node's parent is found in its
   shard, or among the merged boundary nodes of its shard.

Defined results: NULL role or text is empty; NULL turns sort first; ties go by the turn's MD5; a
repeated row is a turn of its own; rows of a NULL conversation id are one conversation, which
names a node only where no other is a member and has no decimal among a node's ends; a conversation
without turns is a member of the root only; a very long text is read once, a conversation is one row
of 12 bytes a turn; other columns are ignored; an empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.paging import with_row_index
from .common import written
from .quality import words_of

SHARD = 1 << 18  # turns of a shard
CHUNK_BITS = 12  # ids of conversations that end at a node are listed in chunks of so many values
FREQUENT = 1000  # a turn in over 1 / FREQUENT of all rows is broadcast


def turn_code(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def encode(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``conv_id, ids, words`` (turn numbers and their word counts, in order), and the dictionary ``code, words, id``."""
    rows = written(conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), turn_code(F.col(role), F.col(text)).alias("code"),
                                        F.size(words_of(F.col(text))).alias("words")))
    counted = rows.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.min("words").alias("words"))
    turns = written(with_row_index(counted, ["code"], "id"))
    often = turns.filter(F.col("n") * FREQUENT > rows.count()).select("code", F.col("id").alias("often"))
    some = rows.join(F.broadcast(often), "code", "left")
    # rows that have their number meet nothing in the dictionary, and are spread
    spread = F.when(F.col("often").isNull(), F.col("code")).otherwise(F.concat(F.lit("-"), F.xxhash64("conv_id", "turn").cast("string")))
    rest = turns.select(F.col("code").alias("known"), "id").hint("merge")
    numbered = some.join(rest, spread == F.col("known"), "left").select("conv_id", F.struct("turn", F.coalesce("often", "id").alias("id"), "words").alias("t"))
    sequences = numbered.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return sequences.select("conv_id", F.col("t.id").alias("ids"), F.col("t.words").alias("words")), turns.select("code", "words", "id")


def rebase(sequences: DataFrame, base: Column, turns: Column, most: int) -> DataFrame:
    """Every conversation with its first ``turns`` (at most ``most``) turns replaced by those of conversation ``base``."""
    heads = sequences.select(F.col("conv_id").alias("_base"), F.slice("ids", 1, most).alias("_ids"), F.slice("words", 1, most).alias("_words"))
    own = sequences.withColumns({"_of": base, "_h": turns})
    both = own.join(heads, F.col("_of") == F.col("_base"), "left")

    def spliced(head: str, own: str, kind: str) -> Column:
        return F.concat(F.coalesce(F.slice(head, F.lit(1), F.col("_h")), F.array().cast(kind)), F.slice(own, F.col("_h") + 1, F.size(own))).alias(own)

    return both.select("conv_id", spliced("_ids", "ids", "array<bigint>"), spliced("_words", "words", "array<int>"))


def _common(a: str, b: str) -> Column:
    """Length of the common prefix of two array columns."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(same, F.lit(False))
    return F.when(at == 0, F.size(a)).otherwise(at - 1).cast("int")


class _Tree:
    """A ternary search tree of sequences; its nodes are the trie's, number 0 the root."""

    def __init__(self) -> None:
        self.key, self.lo, self.eq, self.hi = [0], [0], [0], [0]
        self.parent, self.depth, self.words = [-1], [0], [0]

    def insert(self, ids: list[int], words: list[int]) -> int:
        """The node of the sequence; created parents first."""
        key, parent = self.key, 0
        for place, x in enumerate(ids):
            links, at = self.eq, parent
            while (node := links[at]) and key[node] != x:
                links, at = (self.lo if x < key[node] else self.hi), node
            if not node:
                node = links[at] = len(key)
                key.append(x)
                for link in (self.lo, self.eq, self.hi):
                    link.append(0)
                self.parent.append(parent)
                self.depth.append(place + 1)
                self.words.append(words[place])
            parent = node
        return parent

    def path(self, node: int) -> list[int]:
        """Nodes from the root down."""
        out = []
        while node >= 0:
            out.append(node)
            node = self.parent[node]
        return out[::-1]


NODE = ("shard long, first long, depth int, n long, children long, leaves long, weighted long, distinct long, "
        "parent long, path binary, parent_path binary, ends boolean, own long")


def _shard_nodes(table: pa.Table) -> pa.Table:
    """The nodes of one shard: rows ``shard, ids, words, first, n, shared, extended``."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("ids", "words", "first", "n"))), key=lambda r: r[0])
    shard, shared, extended = (table.column(c)[0].as_py() for c in ("shard", "shared", "extended"))
    tree, end = _Tree(), [0] * len(rows)
    halves = deque([(0, len(rows))])
    while halves:
        a, z = halves.popleft()
        mid = (a + z) // 2
        end[mid] = tree.insert(rows[mid][0], rows[mid][1])
        halves += [h for h in ((a, mid), (mid + 1, z)) if h[0] < h[1]]

    size = len(tree.key)
    first: list[int | None] = [None] * size
    n, children, leaves, weighted, distinct = ([0] * size for _ in range(5))
    local, ends, own = [0] * size, [False] * size, [None] * size
    for node, row in zip(end, rows):
        first[node], n[node], ends[node], own[node] = row[2], row[3], True, row[2]
    earlier = set(tree.path(end[0])[: shared + 1])  # nodes that an earlier shard has as well
    for node in range(size - 1, -1, -1):  # children come before their parents
        if node not in earlier:
            distinct[node] += tree.words[node]
            if not local[node] and not (extended and node == end[-1]):
                leaves[node] += 1
        weighted[node] += n[node] * tree.words[node]
        up = tree.parent[node]
        if up >= 0:
            local[up] += 1
            n[up] += n[node]
            leaves[up] += leaves[node]
            weighted[up] += weighted[node]
            distinct[up] += distinct[node]
            children[up] += node not in earlier
            if first[up] is None or first[node] is not None and first[node] < first[up]:
                first[up] = first[node]
    path: dict[int, bytes] = {}
    for side in (end[0], end[-1]):
        for node in tree.path(side):
            up = tree.parent[node]
            path[node] = hashlib.blake2b(path.get(up, b"") + tree.key[node].to_bytes(8, "big"), digest_size=16).digest()
    inner = [up >= 0 and up not in path for up in tree.parent]
    return pa.table({
        "shard": pa.array([shard] * size, pa.int64()), "first": pa.array(first, pa.int64()), "depth": pa.array(tree.depth, pa.int32()),
        "n": pa.array(n, pa.int64()), "children": pa.array(children, pa.int64()), "leaves": pa.array(leaves, pa.int64()),
        "weighted": pa.array(weighted, pa.int64()), "distinct": pa.array(distinct, pa.int64()),
        "parent": pa.array([first[up] if i else None for up, i in zip(tree.parent, inner)], pa.int64()),
        "path": pa.array([path.get(i) for i in range(size)], pa.binary()),
        "parent_path": pa.array([path.get(up) for up in tree.parent], pa.binary()),
        "ends": pa.array(ends, pa.bool_()), "own": pa.array(own, pa.int64())})


def prefix_trie(sequences: DataFrame, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """The trie of ``sequences`` (``conv_id, ids, words``) and the conversations that end at its nodes.

    Nodes: ``conv_id`` (smallest member), ``depth`` (these two name a node), ``parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens``. Ends: ``conv_id, depth, chunk, members``: sorted ids, those of one node in ascending chunks.
    """
    parts = written(sequences.groupBy("ids", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.first("words").alias("words"), F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_list("conv_id")).alias("members")))
    one = written(parts.groupBy("ids").agg(F.first("words").alias("words"), F.min("first").alias("first"), F.sum("n").alias("n")))
    turns = one.agg(F.sum(F.size("ids").cast("long")).alias("n")).first()["n"] or 0
    dealt = written(one.repartitionByRange(int(turns // shard + 1), "ids").withColumn("shard", F.spark_partition_id().cast("long")))
    # one row per shard
    order = Window.orderBy("shard")
    ends = (dealt.groupBy("shard").agg(F.min("ids").alias("lo"), F.max("ids").alias("hi"))
            .withColumns({"before": F.lag("hi").over(order), "after": F.lead("lo").over(order)}))
    beside = written(ends.select("shard", F.when(F.col("before").isNull(), -1).otherwise(_common("before", "lo")).alias("shared"),
                                 F.coalesce(_common("hi", "after") == F.size("hi"), F.lit(False)).alias("extended")))
    found = written(dealt.join(beside, "shard").groupBy("shard").applyInArrow(_shard_nodes, NODE))
    sums = ("n", "children", "leaves", "weighted", "distinct")
    edge = written(found.filter(F.col("path").isNotNull()).groupBy("path").agg(
        F.min("first").alias("first"), F.max("depth").alias("depth"), *[F.sum(c).alias(c) for c in sums], F.min("parent_path").alias("parent_path"),
        F.max("ends").alias("ends"), F.min("own").alias("own")))
    name = edge.select(F.col("path").alias("parent_path"), F.col("first").alias("parent"))
    merged = edge.join(name, "parent_path", "left")
    # parents on a shard's edge are looked up shard by shard: the root has as many children as there are first turns
    near = found.filter(F.col("path").isNotNull()).select("shard", "path").join(edge.select("path", F.col("first").alias("up")), "path")
    inner = found.filter(F.col("path").isNull()).join(near.withColumnRenamed("path", "parent_path"), ["shard", "parent_path"], "left")
    columns = ["first", "depth", "parent", *sums, "ends", "own"]
    nodes = written(merged.select(*columns).unionByName(inner.withColumn("parent", F.coalesce("up", "parent")).select(*columns)))
    places = nodes.filter("ends").select("own", F.col("first").alias("conv_id"), "depth")
    members = (parts.select("ids", "chunk", "members").join(one.select("ids", F.col("first").alias("seq")), "ids")
               .join(places, F.col("seq").eqNullSafe(F.col("own"))).select("conv_id", "depth", "chunk", "members"))
    return nodes.select(F.col("first").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                        (F.col("weighted") - F.col("distinct")).alias("saved_tokens")), members


def ends_digests(ends: DataFrame) -> DataFrame:
    """``conv_id, depth, ends_sha256`` of the nodes in ``ends``: SHA-256 of the comma-joined decimal members, read as a stream of chunks."""
    rows = ends.select("conv_id", "depth", "chunk", F.array_join(F.col("members").cast("array<string>"), ",").alias("text"))
    rows = rows.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, some = None, None, False
        for b in batches:
            out = []
            for conv, depth, _, text in zip(*(c.to_pylist() for c in b.columns)):
                if (conv, depth) != at:
                    if at is not None:
                        out.append((*at, digest.hexdigest()))
                    at, digest, some = (conv, depth), hashlib.sha256(), False
                if text:
                    digest.update((("," if some else "") + text).encode())
                    some = True
            yield _digest_rows(out)
        if at is not None:
            yield _digest_rows([(*at, digest.hexdigest())])

    return rows.mapInArrow(run, "conv_id long, depth int, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.string()))],
                                      names=["conv_id", "depth", "ends_sha256"])
