"""Conversation prefix trie: member intervals by range minimum over sorted LCPs.

A conversation is the sequence of its turns' keys. Sorted, the conversations
that share a prefix of d turns are neighbours, and two positions lie under one
node of depth d exactly if the least common prefix of the neighbours between
them is d or more. So with a sparse table of minima over those lengths every
candidate prefix finds the left and the right end of its members by binary
search, without a look at any other candidate and without a stack.

Spark sorts the different conversations by range partitioning; a partition is
cut into blocks of bounded size, and a block is searched as one. A node whose
members reach over the edge of its block is open. All that is asked of a node
(members, least id, children, leaves, saved tokens) is a sum or a minimum over
blocks once each block knows how many turns its first and last conversation
share with their neighbours outside, so the open nodes of all blocks, at most
two paths a block, are added up by a grouping, and a node that holds a third
of all conversations is the sum of one row per block. Copies of a conversation
are one row with a count; their ids are hashed in order, a stream of short
pieces made in parallel.

Defined results: a missing role or text is empty; turns go by ``turn``, a
missing one first, equal ones by role and then by the digest of role and text;
rows without a conversation id belong to no conversation; an empty table has
no nodes, not even a root; ids below zero take the remainder as SQL does.
Other columns are not read. A conversation's keys, 24 bytes a turn, are one
row; its texts never are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.common import written

#: Bytes of a turn's key.
KEY = 16
#: SHA-256 of nothing: the ids of a node at which no conversation ends.
NO_IDS = hashlib.sha256(b"").hexdigest()

CLASSES = "seq binary, chars array<long>, n long, least long, ends string"
_BLOCKS = (
    "part long, block long, seqs array<binary>, chars array<array<long>>, ns array<long>, leasts array<long>, "
    "ends array<string>, before long, after long"
)
_NODES = (
    "block long, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


@dataclass(frozen=True)
class TrieParams:
    """``heads`` turns at most come from the conversation whose id is the next lower multiple of ``hub``.

    A block is closed at ``block_rows`` conversations or ``block_turns`` turns.
    ``id_range`` ids go into one piece of a class's joined ids.
    """

    hub: int = 100
    heads: int = 6
    block_rows: int = 20_000
    block_turns: int = 400_000
    id_range: int = 4096


def sequences(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, keys, chars): per turn in order the digest of role and text and the text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).substr(1, 2 * KEY)
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn"), role.alias("role"), key.alias("key"), F.length(text).cast("long").alias("chars")).alias("at"),
    )
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("at"), _by_turn).alias("turns"))
    return ordered.select("conv_id", F.col("turns.key").alias("keys"), F.col("turns.chars").alias("chars"))


def _by_turn(a: Column, b: Column) -> Column:
    """Order of two turns: a missing number first, then role and key."""
    return (
        F.when(a["turn"].isNull() & b["turn"].isNotNull(), -1)
        .when(a["turn"].isNotNull() & b["turn"].isNull(), 1)
        .when(a["turn"] < b["turn"], -1)
        .when(a["turn"] > b["turn"], 1)
        .when(a["role"] < b["role"], -1)
        .when(a["role"] > b["role"], 1)
        .when(a["key"] < b["key"], -1)
        .when(a["key"] > b["key"], 1)
        .otherwise(0)
    )


def rebuilt(own: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """Every conversation with its first turns replaced by as many of its hub's, crc32 of its id modulo ``heads``."""
    conv_id = F.col("conv_id")
    named = own.withColumn("hub", conv_id - conv_id % p.hub).withColumn(
        "taken", (F.crc32(conv_id.cast("string").cast("binary")) % p.heads).cast("int")
    )
    hubs = own.filter(conv_id % p.hub == 0).select(
        conv_id.alias("hub"), *[F.slice(c, 1, p.heads).alias(f"hub_{c}") for c in ("keys", "chars")]
    )

    def joined(column: str) -> Column:
        first = F.slice(F.col(f"hub_{column}"), F.lit(1), F.col("taken"))
        rest = F.slice(F.col(column), F.col("taken") + 1, F.greatest(F.size(column) - F.col("taken"), F.lit(0)))
        return F.when(F.col(f"hub_{column}").isNull(), rest).otherwise(F.concat(first, rest))

    both = named.join(hubs, "hub", "left").select("conv_id", joined("keys").alias("keys"), joined("chars").alias("chars"))
    return both.select("conv_id", F.unhex(F.array_join("keys", "")).alias("seq"), "chars")



def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence from its pieces of joined ids in order; a task holds one batch and one digest."""
    schema = pa.schema([("seq", pa.binary()), ("chars", pa.list_(pa.int64())), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())])
    at, digest = None, None
    for batch in batches:
        done = []
        for seq, chars, n, least, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at is not None and at[0] == seq:
                digest.update(b",")
                at = (*at[:2], at[2] + n, min(at[3], least))
            else:
                if at is not None:
                    done.append((*at, digest.hexdigest()))
                at, digest = (seq, chars, n, least), hashlib.sha256()
            digest.update(ids.encode())
        if done:
            yield _batch(done, schema)
    if at is not None:
        yield _batch([(*at, digest.hexdigest())], schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def classes(convs: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """The different sequences: how many conversations are equal to each, the least id, and the digest of their ids."""
    pieces = convs.groupBy("seq", F.floor(F.col("conv_id") / p.id_range).alias("piece")).agg(
        F.first("chars").alias("chars"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("least"),
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"),
    )
    ordered = pieces.repartition("seq").sortWithinPartitions("seq", "piece")
    return ordered.select("seq", "chars", "n", "least", "ids").mapInArrow(_hash_ids, CLASSES)


def shared_turns(a: bytes, b: bytes) -> int:
    """Length in turns of the common prefix of two sequences."""
    n = min(len(a), len(b)) // KEY * KEY
    x, y = (np.frombuffer(s, np.uint8, n).reshape(-1, KEY) for s in (a, b))
    differ = np.nonzero((x != y).any(axis=1))[0]
    return int(differ[0]) if len(differ) else n // KEY


def _cut(p: TrieParams) -> Callable:
    """Blocks of neighbouring classes; each knows what it shares with its neighbours within the partition."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        schema = pa.schema(
            [("part", pa.int64()), ("block", pa.int64()), ("seqs", pa.list_(pa.binary())), ("chars", pa.list_(longs)), ("ns", longs)]
            + [("leasts", longs), ("ends", pa.list_(pa.string())), ("before", pa.int64()), ("after", pa.int64())]
        )
        rows, turns, number, before, part = [], 0, 0, None, None

        def block(after: int | None) -> pa.RecordBatch:
            seqs, chars, ns, leasts, ends = (list(c) for c in zip(*rows, strict=True))
            return _batch([(part, (part << 32) + number, seqs, chars, ns, leasts, ends, before, after)], schema)

        for batch in batches:
            for part, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):  # noqa: B020
                if rows and (len(rows) >= p.block_rows or turns + len(row[0]) // KEY > p.block_turns):
                    shared = shared_turns(rows[-1][0], row[0])
                    yield block(shared)
                    rows, turns, number, before = [], 0, number + 1, shared
                rows.append(row)
                turns += len(row[0]) // KEY
        if rows:
            yield block(None)

    return cut


class Minima:
    """Sparse table: minima over all runs of 2^k neighbours."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def right_end(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Last position that ``at`` reaches over gaps of at least ``depth``; gap i lies before position i + 1."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            if len(level):
                fits = at < len(level)
                fits &= level[np.minimum(at, len(level) - 1)] >= depth
                at[fits] += 1 << k
        return at

    def left_end(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First position that reaches ``at`` over gaps of at least ``depth``."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[k], 1 << k
            if len(level):
                fits = at >= step
                fits &= level[np.maximum(at - step, 0)] >= depth
                at[fits] -= step
        return at

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum over positions first to last, from the two runs that cover them."""
        out = np.empty(len(first), np.int64)
        run = np.frexp((last - first + 1).astype(float))[1] - 1
        for k in np.unique(run):
            some = run == k
            level = self.levels[k]
            out[some] = np.minimum(level[first[some]], level[last[some] - (1 << k) + 1])
        return out


def block_nodes(seqs: list[bytes], chars: list, ns: list, leasts: list, ends: list, before: int, after: int) -> list[tuple]:
    """Rows of ``_NODES`` without the block: the nodes with members here and what the block adds to each.

    ``before`` and ``after`` count the turns that the first and the last
    sequence share with the neighbour outside, -1 where there is none.
    """
    m = len(seqs)
    size = np.array([len(s) // KEY for s in seqs])
    lcp = np.array([before, *[shared_turns(a, b) for a, b in zip(seqs, seqs[1:])], after], np.int64)
    gaps, ids = Minima(lcp[1:m]), Minima(np.array(leasts, np.int64))
    # candidates: the prefixes that no earlier sequence of the block has, by position and depth
    low = np.concatenate([[0], lcp[1:m] + 1])
    many = size - low + 1
    start = np.concatenate([[0], np.cumsum(many)])
    at = np.repeat(np.arange(m), many)
    depth = np.arange(start[-1]) - start[at] + low[at]
    left, right = gaps.left_end(at, depth), gaps.right_end(at, depth)

    def total(values: np.ndarray, first: np.ndarray, behind: np.ndarray) -> np.ndarray:
        so_far = np.concatenate([[0], np.cumsum(values)])
        return so_far[behind] - so_far[first]

    n_convs = total(np.array(ns, np.int64), left, right + 1)
    least = ids.least(left, right)
    n_leaves = total((size > lcp[1:]).astype(np.int64), left, right + 1)
    # a node is new here unless the sequence before the block has it too
    new = (at > 0) | (depth > before)
    begins = np.concatenate([[0], np.cumsum(size)])
    flat = np.concatenate([np.asarray(c, np.int64) for c in chars] + [np.zeros(1, np.int64)])
    said = np.where(depth > 0, flat[np.maximum(begins[at] + depth - 1, 0)], 0)
    # n_convs is a sum over blocks, so is this; the one conversation that saves nothing counts where the node is new
    saved = total((n_convs - new) * said, np.arange(len(at)), start[right + 1])
    top = gaps.left_end(at, depth - 1)
    parent = np.where(depth > 0, start[top] + depth - 1 - low[top], 0)
    n_children = np.bincount(parent[new & (depth > 0)], minlength=len(at))
    opened = ((left == 0) & (depth <= before)) | ((right == m - 1) & (depth <= after))

    keys: dict[int, bytes] = {}
    for position, shared in ((0, before), (m - 1, after)):  # all open nodes are prefixes of these two
        digest = hashlib.sha256()
        for d in range(shared + 1):
            if d:
                digest.update(seqs[position][(d - 1) * KEY : d * KEY])
            owner = int(gaps.left_end(np.array([position]), np.array([d]))[0])
            keys[int(start[owner] + d - low[owner])] = digest.digest()
    own_end = depth == size[at]
    return [
        (
            keys.get(c),
            keys.get(up) if d else None,
            low_id,
            d,
            None if d == 0 or opened[up] else int(least[up]),
            members,
            children,
            leaves,
            tokens,
            ends[i] if is_end else None,
        )
        for c, (i, up, low_id, d, members, children, leaves, tokens, is_end) in enumerate(
            zip(
                *(x.tolist() for x in (at, parent, least, depth, n_convs, n_children, n_leaves, saved, own_end)), strict=True
            )
        )
    ]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("block", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64())]
        + [("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64())]
        + [("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
    )
    for batch in batches:
        for i in range(batch.num_rows):
            block, seqs, chars, ns, leasts, ends, before, after, last_before, first_after = (
                c[i].as_py() for c in batch.columns
            )
            if before is None:
                before = -1 if last_before is None else shared_turns(last_before, seqs[0])
            if after is None:
                after = -1 if first_after is None else shared_turns(seqs[-1], first_after)
            rows = [(block, *row) for row in block_nodes(seqs, chars, ns, leasts, ends, before, after)]
            for first in range(0, len(rows), 10_000):
                yield _batch(rows[first : first + 10_000], schema)


def nodes(kinds: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """The trie over ``classes``, one row per node."""
    ordered = kinds.repartitionByRange("seq").sortWithinPartitions("seq")
    numbered = ordered.select(F.spark_partition_id().cast("long").alias("part"), "seq", "chars", "n", "least", "ends")
    blocks = written(numbered.mapInArrow(_cut(p), _BLOCKS), "trie-blocks")
    # one row per partition: how it begins and ends
    edges = blocks.groupBy("part").agg(
        F.min_by(F.element_at("seqs", 1), "block").alias("first"), F.max_by(F.element_at("seqs", -1), "block").alias("last")
    )
    in_order = Window.orderBy("part")
    around = edges.select(
        "part", F.lag("last").over(in_order).alias("last_before"), F.lead("first").over(in_order).alias("first_after")
    )
    searched = (
        blocks.join(around, "part")
        .select("block", "seqs", "chars", "ns", "leasts", "ends", "before", "after", "last_before", "first_after")
        .mapInArrow(_search, _NODES)
    )
    found = written(searched, "trie-nodes")
    opened = found.filter("key is not null")
    merged = written(
        opened.groupBy("key", "depth").agg(
            F.first("parent_key").alias("parent_key"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.max("ends_sha256").alias("ends_sha256"),
        ),
        "trie-open",
    )
    ids = merged.select("key", F.col("conv_id").alias("parent_id"))
    tops = merged.join(ids.withColumnRenamed("key", "parent_key"), "parent_key", "left")
    # a closed node below an open one finds it by block and key, so no key has more rows than a block
    above = opened.select("block", "key").join(ids, "key").withColumnRenamed("key", "parent_key")
    closed = found.filter("key is null")
    inside = closed.filter("parent_key is null").withColumn("parent_id", F.col("parent_conv_id"))
    below = closed.filter("parent_key is not null").join(above, ["block", "parent_key"])
    columns = [
        "conv_id",
        "depth",
        F.col("parent_id").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
    ]
    return tops.select(*columns).unionByName(inside.select(*columns)).unionByName(below.select(*columns))


def prefix_trie(conversations: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """The registered query: the trie of the rebuilt conversations."""
    return nodes(classes(rebuilt(sequences(conversations), p), p), p)


SQL = """
with turns as (
  select conv_id, turn, coalesce(role, '') role, coalesce("text", '') body from conversations where conv_id is not null
), own as (
  select conv_id, list({'r': role, 't': body} order by turn nulls first, role, body) seq from turns group by conv_id
), numbered as (
  select conv_id, seq, conv_id - conv_id % 100 hub,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::bigint, flatten(list_transform(range(1, length(conv_id::varchar) + 1),
        lambda i: [ord((conv_id::varchar)[i])::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda crc, x: case when x >= 0 then xor(crc, x) else xor(crc >> 1, (crc & 1) * 3988292384) end)) % 6 h
  from own
), rebuilt as (
  select a.conv_id, list_concat(coalesce(b.seq[1:a.h], []), coalesce(a.seq[a.h + 1:], [])) seq
  from numbered a left join own b on b.conv_id = a.hub
), members as (
  select conv_id, len(seq) = d is_end, d, seq[1:d] prefix from rebuilt, unnest(range(0, len(seq) + 1)) t(d)
), nodes as (
  select prefix, d, min(conv_id) conv_id, count(*) n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (is_end), '')) ends_sha256
  from members group by prefix, d
), counted as (
  select n.*, (select count(*) from nodes c where c.d = n.d + 1 and c.prefix[1:n.d] = n.prefix) n_children from nodes n
), sums as (
  select a.prefix, a.d, count(*) filter (b.n_children = 0) n_leaves,
    sum(case when b.d = 0 then 0 else (b.n_convs - 1) * length(b.prefix[b.d].t) end) saved_tokens
  from counted a join counted b on b.d >= a.d and b.prefix[1:a.d] = a.prefix group by a.prefix, a.d
)
select n.conv_id, n.d depth, p.conv_id parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
  cast(s.saved_tokens as bigint) saved_tokens, n.ends_sha256
from counted n join sums s on s.d = n.d and s.prefix = n.prefix
left join counted p on p.d = n.d - 1 and p.prefix = n.prefix[1:n.d - 1]
"""
