"""The trie of conversation prefixes from range minima over sorted common prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import parts, stage, table, word_count

#: Bytes that stand for a turn: a 128-bit digest of its role and text.
TURN = 16
#: Turns that one task sorts and indexes, about 250 bytes of memory each.
TURNS_PER_TASK = 1_000_000
EMPTY = hashlib.sha256().hexdigest()
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, t``: the turns of each conversation in order, as digests with the words of their text."""
    role_of, text_of = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    digest = F.md5(F.concat(F.length(role_of).cast("string"), F.lit(":"), role_of, text_of))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).isNotNull().alias("numbered"), F.col(turn).alias("turn"), role_of.alias("role"), digest.alias("digest"), word_count(text_of).alias("words")
        ).alias("t"),
    )
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda x: F.struct(x["digest"].alias("digest"), x["words"].alias("words"))).alias("t"))


def _sequences(turned: DataFrame) -> DataFrame:
    """``conv_id, key, words`` with the digests of a conversation's turns one after another."""
    key = F.unhex(F.array_join(F.transform("t", lambda x: x["digest"]), ""))
    return turned.select("conv_id", key.alias("key"), F.transform("t", lambda x: x["words"]).alias("words"))


def conversation_sequences(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, key, words`` of each conversation, its turns in order.

    Null turn numbers come first, equal ones in the order of role and digest; a null role or text is empty;
    repeated rows are turns of their own; rows without a conv_id belong to no conversation. Other columns
    are not read. A turn is known by a 128-bit digest, and texts do not travel. The digests of one
    conversation, 16 bytes a turn, have to fit a row.
    """
    return _sequences(_turns(conversations, conv_id, turn, role, text))


def with_openings(conversations: DataFrame, own: Column, opener: Column, most: int, **columns: str) -> DataFrame:
    """Sequences whose first turns are those of another conversation.

    ``own`` says how many turns of a conversation, at most ``most``, are replaced by as many first turns of
    the conversation ``opener`` (all if it has fewer, none if it is absent); both are columns over
    ``conv_id``.
    """
    names = {"conv_id": "conv_id", "turn": "turn", "role": "role", "text": "text"} | columns
    turned = stage(_turns(conversations, **names).withColumns({"opener": opener, "own": own}), "turns")
    openings = turned.select(F.col("conv_id").alias("opener"), F.slice("t", 1, most).alias("opening"))
    # only conversations that are asked for
    openings = openings.join(turned.where("own > 0").select("opener").distinct(), "opener", "left_semi")
    nothing = F.slice("t", 1, 0)
    opening = F.slice(F.coalesce("opening", nothing), F.lit(1), F.col("own"))
    rest = F.slice("t", F.col("own") + 1, F.greatest(F.size("t") - F.col("own"), F.lit(0)))
    return _sequences(turned.join(openings, "opener", "left").select("conv_id", F.concat(opening, rest).alias("t")))


class _Minima:
    """Sparse table: minima of all ranges of a power of two, so that any range is two of them."""

    def __init__(self, values: np.ndarray, beyond: int):
        self.levels, width = [values], 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            row = np.full(len(values), beyond, values.dtype)
            row[: len(values) - 2 * width + 1] = np.minimum(last[: len(values) - 2 * width + 1], last[width : len(values) - width + 1])
            self.levels.append(row)
            width *= 2

    def least(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The minimum of each range, both ends included."""
        level = np.frexp((right - left + 1).astype(float))[1] - 1
        out = np.empty(len(left), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][left[at]], self.levels[k][right[at] - (1 << k) + 1])
        return out


@dataclass
class Forest:
    """Sorted sequences, their common prefixes and the distinct prefixes (nodes) in preorder.

    ``keys`` are the sequences' turns one after another, ``offset`` and ``length`` their place; the node of
    a prefix belongs to the first sequence that starts with it.
    """

    keys: np.ndarray
    length: np.ndarray

    @cached_property
    def offset(self) -> np.ndarray:
        return np.cumsum(self.length) - self.length

    @cached_property
    def common(self) -> np.ndarray:
        """Turns that each sequence shares with the one before; -1 for the first, which shares not even the root."""
        found = np.zeros(len(self.length), np.int64)
        found[:1] = -1
        alive, depth = np.arange(1, len(self.length)), 0
        while len(alive):
            alive = alive[np.minimum(self.length[alive], self.length[alive - 1]) > depth]
            alive = alive[self.keys[self.offset[alive] + depth] == self.keys[self.offset[alive - 1] + depth]]
            depth += 1
            found[alive] = depth
        return found

    @cached_property
    def minima(self) -> _Minima:
        return _Minima(self.common, -1)

    @cached_property
    def start(self) -> np.ndarray:
        """Number of the first node that belongs to each sequence, and behind it the number of nodes."""
        return np.append(0, np.cumsum(self.length - self.common))

    @cached_property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.length)), np.diff(self.start))

    @cached_property
    def depth(self) -> np.ndarray:
        return self.common[self.row] + 1 + np.arange(len(self.row)) - self.start[self.row]

    def left(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first sequence with the same ``depth`` first turns, by binary search over range minima."""
        at = row.copy()
        for k in reversed(range(len(self.minima.levels))):
            to = at - (1 << k)
            at = np.where((to >= 0) & (self.minima.levels[k][np.maximum(to, 0) + 1 - (to < 0)] >= depth), to, at)
        return at

    def right(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last sequence with the same ``depth`` first turns."""
        at, last = row.copy(), len(self.length) - 1
        for k in reversed(range(len(self.minima.levels))):
            to = at + (1 << k)
            at = np.where((to <= last) & (self.minima.levels[k][np.minimum(at + 1, last)] >= depth), to, at)
        return at

    def node(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The node of a prefix of any sequence."""
        first = self.left(row, depth)
        return self.start[first] + depth - self.common[first] - 1

    @cached_property
    def last(self) -> np.ndarray:
        """Last member of each node; the first one is its ``row``."""
        return self.right(self.row, self.depth)

    @cached_property
    def end(self) -> np.ndarray:
        """Number behind the last node of each node's subtree, which starts with the node itself."""
        return self.start[self.last + 1]

    @cached_property
    def parent(self) -> np.ndarray:
        """The parent of every node, -1 for the root."""
        found = np.full(len(self.row), -1)
        below = self.depth > 0
        found[below] = self.node(self.row[below], self.depth[below] - 1)
        return found

    def of_last_turn(self, words: np.ndarray) -> np.ndarray:
        """The words of each node's last turn, 0 for the root."""
        below = self.depth > 0
        out = np.zeros(len(self.row), np.int64)
        out[below] = words[self.offset[self.row[below]] + self.depth[below] - 1]
        return out

    def over_subtree(self, values: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(values))
        return total[self.end] - total[:-1]


def _forest(keys: pa.Array) -> Forest:
    flat = np.frombuffer(b"".join(keys.to_pylist()), f"S{TURN}").view(np.dtype((np.void, TURN)))
    return Forest(flat, np.asarray(pc.binary_length(keys)).astype(np.int64) // TURN)


def _rows(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found).combine_chunks() if found else None


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(lists.combine_chunks().flatten()).astype(np.int64)


# One schema for what a range of sorted sequences yields: finished nodes, first and last sequence, ids that end in a node.
FOUND = (
    "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "edge long, edge_depth long, ids string, key binary, words array<long>, n array<long>, least array<long>, children array<long>, leaves array<long>, saved array<long>"
)
INSIDE, EDGE, ENDS = 0, 1, 2
_LISTS = ("words", "n", "least", "children", "leaves", "saved")


def _found(kind: int, rows: int, **columns) -> pa.RecordBatch:
    arrays, names = [], []
    for field in FOUND.split(", "):
        name, spelled = field.split(" ")
        kind_of = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}[spelled]
        values = pa.array([kind] * rows, kind_of) if name == "kind" else columns.get(name)
        if not isinstance(values, pa.Array):
            values = pa.nulls(rows, kind_of) if values is None else pa.array(values, kind_of)
        arrays.append(values)
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _range_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one range of sorted sequences.

    A node that neither the first nor the last sequence starts with lies in this range alone and is
    finished. Of the others, which may go on in the ranges beside, the range yields what it holds of each,
    with its first and last sequence: members, children, leaves and saved tokens of finished nodes.
    """
    rows = _rows(batches)
    if rows is None:
        return
    ids, keys = np.asarray(rows.column("conv_id")), rows.column("key").combine_chunks()
    words = _flat(rows.column("words"))
    trie = _forest(keys)
    size, last_row = len(ids), len(ids) - 1
    n = trie.last - trie.row + 1
    least = _Minima(ids, 2**63 - 1).least(trie.row, trie.last)
    inside = (trie.row > 0) & (trie.last < last_row)
    own = (n - 1) * trie.of_last_turn(words)
    leaf = trie.end == np.arange(len(n)) + 1
    leaves, saved = trie.over_subtree(leaf & inside), trie.over_subtree(np.where(inside, own, 0))
    children = np.bincount(trie.parent[inside], minlength=len(n))

    # sequences that are equal follow one another, by id; they end in one node
    fresh = np.ones(size, bool)
    fresh[1:] = (trie.common[1:] < trie.length[1:]) | (trie.length[1:] != trie.length[:-1])
    begin = np.flatnonzero(fresh)
    ends_in = trie.node(begin, trie.length[begin])
    text = list(map(str, ids.tolist()))
    stop = [*begin[1:].tolist(), size]
    joined = [",".join(text[a:b]) for a, b in zip(begin.tolist(), stop, strict=True)]

    digest = [EMPTY] * len(n)
    for node, x, closed in zip(ends_in.tolist(), joined, inside[ends_in].tolist(), strict=True):
        if closed:
            digest[node] = hashlib.sha256(x.encode()).hexdigest()
    at = np.flatnonzero(inside)
    above = trie.parent[at]
    open_above = ~inside[above]
    # the boundary sequence that an open node is reported with: the first where it can be, else the last
    edge = np.where(trie.row == 0, ids[0], ids[-1])
    yield _found(
        INSIDE, len(at),
        conv_id=least[at], depth=trie.depth[at], n_convs=n[at], n_children=children[at], n_leaves=leaves[at], saved_tokens=saved[at],
        parent_conv_id=pa.array(least[above], mask=open_above), ends_sha256=[digest[i] for i in at.tolist()],
        edge=pa.array(edge[above], mask=~open_above), edge_depth=pa.array(trie.depth[above], mask=~open_above),
    )

    def boundary(row: int, other: int) -> pa.RecordBatch:
        depths = np.arange(trie.length[row] + 1)
        nodes = trie.node(np.full(len(depths), row), depths)
        mine = edge[nodes] == ids[row] if other != row else np.ones(len(nodes), bool)
        values = {"n": n, "children": children, "leaves": leaves, "saved": saved}
        lists = {name: [np.where(mine, x[nodes], 0).tolist()] for name, x in values.items()}
        own_words = words[trie.offset[row] : trie.offset[row] + trie.length[row]]
        return _found(EDGE, 1, conv_id=[ids[row]], key=[keys[row].as_py()], words=[own_words.tolist()], least=[least[nodes].tolist()], **lists)

    yield boundary(0, last_row)
    if last_row:
        yield boundary(last_row, 0)
    open_ends = np.flatnonzero(~inside[ends_in])
    nodes = ends_in[open_ends]
    yield _found(
        ENDS, len(nodes), conv_id=ids[begin[open_ends]], edge=edge[nodes], edge_depth=trie.depth[nodes], ids=[joined[i] for i in open_ends.tolist()]
    )


EDGE_NODES = "edge long, edge_depth long, first boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _edge_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes that boundary sequences start with, by the same searches over these sequences.

    A row for every prefix of every boundary sequence; ``first`` marks one of each node.
    """
    rows = _rows(batches)
    if rows is None:
        return
    ids = np.asarray(rows.column("conv_id"))
    trie = _forest(rows.column("key").combine_chunks())
    got = {name: _flat(rows.column(name)) for name in _LISTS}
    row = np.repeat(np.arange(len(ids)), trie.length + 1)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(trie.length + 1) - trie.length - 1, trie.length + 1)
    node, size = trie.node(row, depth), len(trie.row)

    def added(name: str) -> np.ndarray:
        out = np.zeros(size, np.int64)
        np.add.at(out, node, got[name])
        return out

    n, least = added("n"), np.full(size, 2**63 - 1)
    np.minimum.at(least, node, got["least"])
    below = trie.parent >= 0
    children = added("children") + np.bincount(trie.parent[below], minlength=size)
    leaves = added("leaves") + trie.over_subtree(children == 0)
    saved = added("saved") + trie.over_subtree((n - 1) * trie.of_last_turn(got["words"]))
    parent = pa.array(least[trie.parent], mask=~below)
    first = np.zeros(len(row), bool)
    first[np.unique(node, return_index=True)[1]] = True
    columns = [ids[row], depth, first, least[node], depth, parent.take(pa.array(node)), n[node], children[node], leaves[node], saved[node]]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[x.split(" ")[0] for x in EDGE_NODES.split(", ")])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for the lists of ids of each node, which come one after another in order."""
    now, state, out = None, None, []
    for batch in batches:
        for conv_id, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if (conv_id, depth) == now:
                state.update(b"," + ids.encode())
                continue
            if now is not None:
                out.append((*now, state.hexdigest()))
            now, state = (conv_id, depth), hashlib.sha256(ids.encode())
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["conv_id", "depth", "ends"])
        out = []
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, state.hexdigest())], names=["conv_id", "depth", "ends"])


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """Every distinct prefix of ``conv_id, key, words`` with its members: one row per node, the root at depth 0.

    A node is named by its smallest member and its depth. ``n_convs`` members start with it, ``n_children``
    nodes are one turn longer, ``n_leaves`` of its subtree have no child; ``saved_tokens`` adds up, over the
    subtree, (members - 1) times the words of the last turn; ``ends_sha256`` is the digest of the members
    that end there. Ids are unique. An empty table has no node, not even the root.

    Sequences are sorted in ranges of about ``TURNS_PER_TASK`` turns, equal ones by id, so that a prefix of
    a third of all conversations spreads over a third of the ranges. Inside a range, each distinct prefix
    searches its left and right end by range minima over the common prefixes of neighbours. Prefixes of a
    range's first or last sequence may go on beside it: these sequences, two for each range, meet in one
    task, where the same searches put the ranges' shares together. Ids that end in such a prefix arrive in
    order, as one list from each range, and are digested as a stream.
    """
    spark = sequences.sparkSession
    stored = stage(sequences, "sequences")
    turns = stored.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    n = max(parts(spark), turns // TURNS_PER_TASK + 1)
    ranges = stored.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = stage(ranges.mapInArrow(_range_nodes, FOUND), "ranges")

    edges = found.where(F.col("kind") == EDGE).select("conv_id", "key", *_LISTS)
    edges = stage(edges.repartition(1).sortWithinPartitions("key", "conv_id").mapInArrow(_edge_nodes, EDGE_NODES), "edges")
    names = edges.select("edge", "edge_depth", F.col("conv_id").alias("name"))
    inside = found.where(F.col("kind") == INSIDE)
    below_edge = inside.where("edge IS NOT NULL").join(names, ["edge", "edge_depth"]).withColumn("parent_conv_id", F.col("name"))

    ends = found.where(F.col("kind") == ENDS).join(names, ["edge", "edge_depth"])
    ends = ends.select(F.col("name").alias("conv_id"), F.col("edge_depth").alias("depth"), F.col("conv_id").alias("from_id"), "ids")
    ends = ends.repartition(n, "conv_id", "depth").sortWithinPartitions("conv_id", "depth", "from_id")
    ends = ends.mapInArrow(_digests, "conv_id long, depth long, ends string")
    nodes = edges.where("first").join(ends, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(EMPTY)))
    finished = inside.where("edge IS NULL").select(*NODE).union(below_edge.select(*NODE))
    return finished.union(nodes.select(*NODE))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations that start with up to three turns of every twentieth one."""
    own = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    opener = F.col("conv_id") - F.col("conv_id") % 20
    return prefix_trie(with_openings(table(spark, sf_dir, "conversations"), own.cast("int"), opener, 3))


OP11_SQL = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
    FROM conversations WHERE conv_id IS NOT NULL
), checksums AS (
    SELECT conv_id, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, unused: xor(c >> 1, 3988292384 * (c & 1)))
    )) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT s.conv_id, o.n, o.role, o.text FROM checksums s JOIN turns o ON o.conv_id = s.conv_id - s.conv_id % 20 AND o.n <= s.h
    UNION ALL
    SELECT s.conv_id, o.n, o.role, o.text FROM checksums s JOIN turns o ON o.conv_id = s.conv_id AND o.n > s.h
), sequences AS (
    SELECT s.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.n) FILTER (r.n IS NOT NULL), []) AS seq
    FROM checksums s LEFT JOIN rebuilt r USING (conv_id) GROUP BY s.conv_id
), members AS (
    SELECT conv_id, d AS depth, seq[1:d] AS prefix, len(seq) = d AS ends FROM sequences, generate_series(0, (SELECT max(len(seq)) FROM sequences)) g(d) WHERE d <= len(seq)
), nodes AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY prefix, depth
), children AS (
    SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), own AS (
    SELECT n.*, coalesce(c.n_children, 0) AS n_children,
        CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.prefix[n.depth].text, '[^\x20\x09-\x0D]+')) END AS saved
    FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.prefix = n.prefix
), subtrees AS (
    SELECT prefix[1:d] AS prefix, d AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM own, generate_series(0, (SELECT max(depth) FROM own)) g(d) WHERE d <= depth GROUP BY ALL
)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
FROM own o JOIN subtrees s ON s.depth = o.depth AND s.prefix = o.prefix LEFT JOIN nodes p ON p.depth = o.depth - 1 AND p.prefix = o.prefix[1:o.depth - 1]
"""
