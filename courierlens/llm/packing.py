"""Packing documents into sequences of fixed capacity by exact complements, then best fit.

Every document becomes token pieces of at most ``capacity``. The plan needs
only how many pieces there are of each length: at most ``capacity`` numbers,
whatever the number of documents. It is made on the driver from this histogram
and says, per combination of lengths, how many sequences are filled with it:

1. a piece opens a sequence and its gap is closed exactly by one other length,
2. by two lengths whose sum is indexed,
3. by three, the third found through the index of pairs,
4. what is left goes, longest first, where the gap left is least.

Pieces then find their place by arithmetic: the n-th piece of a length belongs
to the combination whose range of ranks holds n. Ranks come from counts per
task, so no task sees all pieces of a length.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.bpe import read_ranks
from courierlens.llm.common import written
from courierlens.llm.wordcoder import WordCoder, to_bytes

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, place bigint"
PLACED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


@dataclass(frozen=True)
class PackParams:
    """``ranks`` is the path of a rank file, ``pattern`` what its tokenizer cuts texts by.

    ``added`` holds the (string, id) of tokens that are found in a text before it is cut.
    """

    ranks: str
    pattern: str
    capacity: int = 1024
    end_id: int = 2
    added: tuple[tuple[str, int], ...] = ()


def added_tokens(path: str) -> tuple[tuple[str, int], ...]:
    """(string, id) of the added tokens of a tokenizer file; those that look beyond their own string are an error."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    for token in tokens:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"added token {token['content']!r} needs more than its own string")
    return tuple((token["content"], token["id"]) for token in tokens)


class AddedCoder:
    """Cuts texts at the added tokens, the longest first, and encodes what lies between them apart."""

    def __init__(self, coder: WordCoder, added: tuple[tuple[str, int], ...]):
        self.coder, self.ids = coder, {token: to_bytes([number]) for token, number in added}
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.ids, key=len, reverse=True))) + ")")

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        # every second part is an added token
        cut = [self.cuts.split(t) if t and any(token in t for token in self.ids) else [t] for t in texts]
        between = iter(self.coder.encode([part for parts in cut for part in parts[::2]]))
        return [b"".join(self.ids[p] if at % 2 else next(between) for at, p in enumerate(parts)) for parts in cut]


def file_coder(path: str, pattern: str, added: tuple[tuple[str, int], ...] = ()) -> WordCoder | AddedCoder:
    """Coder of a rank file; strings of special tokens in a text are ordinary text unless they are ``added``."""
    import tiktoken

    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    coder = WordCoder(lambda words: [to_bytes(encoding.encode_ordinary(w)) for w in words])
    return AddedCoder(coder, added) if added else coder


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than the capacity."""
    first = tokens if tokens <= capacity else tokens % capacity
    starts = ([0] if first else []) + list(range(first, tokens, capacity))
    return [(s, first if s == 0 and first else capacity) for s in starts]


def _pieces_of(params: PackParams):
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, coder = TaskContext.get().partitionId(), file_coder(params.ranks, params.pattern, params.added)
        seen = [0] * (params.capacity + 1)
        end = to_bytes([params.end_id])
        for rows in batches:
            found = []
            for doc_id, ids in zip(rows["doc_id"], coder.encode(rows["text"]), strict=True):
                ids += end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, params.capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    found.append((doc_id, piece, start, length, crc, part, seen[length]))
                    seen[length] += 1
            columns = list(zip(*found, strict=True)) or [()] * 7
            frame = pd.DataFrame(dict(zip(PIECE_NAMES, columns, strict=True)))
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return pieces


PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]


def token_pieces(documents: DataFrame, params: PackParams) -> DataFrame:
    """Pieces of all documents, numbered within (task, length); null texts are empty and become the end id alone."""
    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(_pieces_of(params), PIECES)


@dataclass(frozen=True)
class Filling:
    """``times`` sequences, each holding these runs of (length, how many)."""

    runs: tuple[tuple[int, int], ...]
    times: int

    @property
    def used(self) -> int:
        return sum(length * count for length, count in self.runs)


def _take(left: np.ndarray, lengths: tuple[int, ...]) -> Filling | None:
    """As many sequences of these lengths as the counts allow; the counts go down."""
    kinds = {length: lengths.count(length) for length in lengths}
    times = min(int(left[length]) // count for length, count in kinds.items())
    if not times:
        return None
    for length, count in kinds.items():
        left[length] -= count * times
    return Filling(tuple(sorted(kinds.items(), reverse=True)), times)


def exact_fillings(left: np.ndarray, capacity: int) -> list[Filling]:
    """Combinations of one to four lengths that fill a sequence exactly; ``left`` keeps what they do not use."""
    found: list[Filling | None] = [_take(left, (capacity,))]
    for others in (1, 2, 3):
        for opener in range(capacity - 1, 0, -1):
            if left[opener]:
                found += _close(left, (opener,), capacity - opener, others)
    return [f for f in found if f]


def _close(left: np.ndarray, opened: tuple[int, ...], gap: int, others: int) -> list[Filling | None]:
    """Fill the gap with exactly ``others`` lengths, none above the last one opened."""
    if others == 1:
        return [_take(left, (*opened, gap))] if 0 < gap <= opened[-1] and left[gap] else []
    if others == 2:
        high = min(opened[-1], gap - 1)
        low = (gap + 1) // 2
        if high < low:
            return []
        # the index of pair sums: both lengths at hand and together as long as the gap
        longer = np.flatnonzero((left[low : high + 1] > 0) & (left[gap - high : gap - low + 1][::-1] > 0)) + low
        return [_take(left, (*opened, int(a), gap - int(a))) for a in longer[::-1]]
    found: list[Filling | None] = []
    for length in np.flatnonzero(left[: min(opened[-1], gap - 2) + 1])[::-1]:
        if not left[opened[0]] or 3 * length < gap:
            break
        found += _close(left, (*opened, int(length)), gap - int(length), others - 1)
    return found


def best_fit(left: np.ndarray, capacity: int) -> list[Filling]:
    """Longest lengths first, each into the open sequences with the least gap that holds it."""
    open_by_gap: dict[int, list[Filling]] = {}

    def put(filling: Filling) -> None:
        open_by_gap.setdefault(capacity - filling.used, []).append(filling)

    for length in range(capacity, 0, -1):
        count = int(left[length])
        left[length] = 0
        for gap in sorted(g for g in open_by_gap if g >= length) if count else []:
            for filling in open_by_gap.pop(gap):
                each = gap // length
                full = min(filling.times, count // each)
                rest = count - full * each if full < filling.times else 0
                for times, pieces in ((full, each), (1 if rest else 0, rest)):
                    if times:
                        put(Filling((*filling.runs, (length, pieces)), times))
                        count -= times * pieces
                if filling.times - full - bool(rest):
                    put(Filling(filling.runs, filling.times - full - bool(rest)))
            if not count:
                break
        each = capacity // length
        if count // each:
            put(Filling(((length, each),), count // each))
        if count % each:
            put(Filling(((length, count % each),), 1))
    return [f for fillings in open_by_gap.values() for f in fillings]


def plan(counts: dict[int, int], capacity: int) -> list[Filling]:
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    return exact_fillings(left, capacity) + best_fit(left, capacity)


def ranges(fillings: list[Filling], capacity: int) -> dict[int, np.ndarray]:
    """By length, rows (first rank, first sequence, pieces per sequence, first offset) in order of rank."""
    used, first, rows = [0] * (capacity + 1), 0, {}
    for filling in fillings:
        offset = 0
        for length, pieces in filling.runs:
            rows.setdefault(length, []).append((used[length], first, pieces, offset))
            used[length] += pieces * filling.times
            offset += pieces * length
        first += filling.times
    return {length: np.array(found, np.int64) for length, found in rows.items()}


def _place_by(found: dict[int, np.ndarray]):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            length, rank = rows["length"].to_numpy(), rows["rank"].to_numpy()
            sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            for value in np.unique(length):
                here = np.flatnonzero(length == value)
                table = found[int(value)]
                start, first, pieces, at = table[np.searchsorted(table[:, 0], rank[here], "right") - 1].T
                sequence[here] = first + (rank[here] - start) // pieces
                offset[here] = at + (rank[here] - start) % pieces * value
            placed = rows.drop(columns="rank").assign(sequence_id=sequence, offset=offset)
            placed["doc_id"] = placed["doc_id"].astype("Int64")
            yield placed

    return place


def pack(documents: DataFrame, params: PackParams) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are packed as the end id alone, a row without id keeps
    a null id, repeated rows are packed each, long texts are cut and never
    shortened, other columns are ignored, no documents give no rows. The pieces
    are written once to the shared folder, without their ids; the texts are
    encoded a single time. To the driver come one count per length.
    """
    pieces = written(token_pieces(documents, params), "pieces")
    counts = pieces.groupBy("length").count().collect()
    found = ranges(plan({r["length"]: r["count"] for r in counts}, params.capacity), params.capacity)
    per_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_task.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = pieces.join(firsts, ["length", "part"]).select(
        *[c for c in PIECE_NAMES[:5]], (F.col("place") + F.col("first")).alias("rank")
    )
    return ranked.mapInPandas(_place_by(found), PLACED)
