"""Byte-level BPE over many texts at once: corpus-level merge replay, and decoding.

All words that texts bring new to a task are laid out as one chain of bytes.
An inverted index holds, for every mergeable pair, the positions where it
stands. Merges are then applied in rank order to all their positions together;
each application links the pair's neighbours anew and enters the two pairs that
arise into the index. Only neighbours of a merge are ever touched, so a word of
n bytes costs n log n however long it is. Ids of a word are kept for the texts
that follow in the task; no word is shared between tasks, which would cost a
shuffle of every occurrence.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.llm.wordcoder import to_bytes

SHIFT = 32


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file with a base64 token and a rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class MergeReplay:
    """Merges of a vocabulary of ranks; a pair merges if its bytes together are a token.

    Pairs that stand at ``many`` positions or more, as ranks go by, are merged as arrays.
    """

    def __init__(self, ranks: dict[bytes, int], many: int = 24):
        self.ranks, self.many = ranks, many
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = {
            ranks[token[:i]] << SHIFT | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        codes = np.fromiter(self.pairs, np.int64, len(self.pairs))
        order = np.argsort(codes)
        self.codes, self.code_ranks = codes[order], np.fromiter(self.pairs.values(), np.int64, len(codes))[order]

    def _first_pairs(self, ids: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each position, -1 where none merges."""
        found = np.full(len(ids), -1, np.int64)
        code = ids[:-1] << SHIFT | ids[1:]
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        match = (self.codes[place] == code) & ~last[:-1]
        found[:-1][match] = self.code_ranks[place[match]]
        return found

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word, as the bytes of 32-bit numbers."""
        lengths = np.array([len(w) for w in words], np.int64)
        if not lengths.sum():
            return [b""] * len(words)
        ends = np.cumsum(lengths)
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        last = np.zeros(len(ids), bool)
        last[ends[lengths > 0] - 1] = True
        merged, irregular = self._replay(ids, self._first_pairs(ids, last), last)
        ids = np.array(merged, np.int64)
        live = ids >= 0
        flat = ids[live].astype("<u4").tobytes()
        bounds = np.concatenate([[0], np.cumsum(live)[np.maximum(ends - 1, 0)]])
        bounds[1:][ends == 0] = 0
        found = [flat[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for position in irregular:
            word = int(np.searchsorted(ends, position, "right"))
            found[word] = to_bytes(self.encode_alone(words[word]))
        return found

    def _replay(self, ids: np.ndarray, pair: np.ndarray, last: np.ndarray) -> tuple[list[int], set[int]]:
        """Ids with -1 where a byte has gone into the token before it, and places in words that are to be done alone.

        Few pairs stand at most of the positions: as long as a pair has many,
        they merge as arrays; the long tail of rare pairs follows one by one.
        """
        size = len(ids)
        places = np.flatnonzero(pair >= 0)
        places = places[np.argsort(pair[places], kind="stable")]
        ordered = pair[places]
        cuts = np.flatnonzero(np.diff(ordered)) + 1
        index = {int(pair[p[0]]): [p] for p in np.split(places, cuts) if len(p)}
        # neighbours within the word; -1 beyond its ends
        after = np.where(last, -1, np.arange(1, size + 1))
        before = np.where(np.concatenate([[True], last[:-1]]), -1, np.arange(-1, size - 1))
        heap, irregular, usual = list(index), set(), 4.0 * self.many
        marked = np.zeros(size, bool)
        heapq.heapify(heap)
        while heap and usual >= self.many:
            rank = heapq.heappop(heap)
            found = index.pop(rank)
            at = np.sort(np.concatenate(found)) if len(found) > 1 else found[0]
            usual += (len(at) - usual) / 64
            at = at[pair[at] == rank]  # elsewhere a neighbour has merged meanwhile
            if not len(at):
                continue
            at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            marked[at] = True
            behind = after[at]
            overlap = marked[behind] & (behind >= 0)
            marked[at] = False
            if overlap.any():
                at = self._leftmost(at.tolist(), after)
            self._merge_all(rank, at, ids, pair, after, before, index, heap, irregular)
        lists = {rank: np.unique(np.concatenate(p)).tolist() for rank, p in index.items()}
        return self._replay_rare(ids.tolist(), pair.tolist(), after.tolist(), before.tolist(), lists, irregular)

    @staticmethod
    def _leftmost(at: list[int], after: np.ndarray) -> np.ndarray:
        """Positions from left to right without those that lie in a pair before them, as in a run of one letter."""
        taken, inside = [], -1
        for position in at:
            if position != inside:
                taken.append(position)
                inside = int(after[position])
        return np.array(taken)

    def _merge_all(self, rank, at, ids, pair, after, before, index, heap, irregular) -> None:
        """Merge the pairs at positions that do not overlap, and enter the pairs that arise."""
        gone = after[at]
        far = after[gone]
        ids[at], ids[gone], pair[gone] = rank, -1, -1
        after[at] = far
        within = far >= 0
        before[far[within]] = at[within]
        pair[at[~within]] = -1
        near = before[at]
        left = np.concatenate([near[near >= 0], at[within]])
        if not len(left):
            return
        code = ids[left] << SHIFT | ids[after[left]]
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        new = np.where(self.codes[place] == code, self.code_ranks[place], -1)
        pair[left] = new
        irregular.update(left[(new >= 0) & (new < rank)].tolist())  # an earlier merge has become possible
        known = new >= 0
        left, new = left[known], new[known]
        order = np.argsort(new, kind="stable")
        left, new = left[order], new[order]
        for part in np.split(np.arange(len(new)), np.flatnonzero(np.diff(new)) + 1) if len(new) else ():
            key = int(new[part[0]])
            if key in index:
                index[key].append(left[part])
            else:
                index[key] = [left[part]]
                heapq.heappush(heap, key)

    def _replay_rare(self, ids, pair, after, before, index, irregular) -> tuple[list[int], set[int]]:
        lookup = self.pairs.get
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            for at in sorted(index.pop(rank)):
                if pair[at] != rank:
                    continue  # a neighbour has merged meanwhile
                gone = after[at]
                far = after[gone]
                ids[at], ids[gone], pair[gone] = rank, -1, -1
                after[at] = far
                near = before[at]
                for left, right in ((near, at), (at, far)):
                    if left < 0 or right < 0:
                        if left == at:
                            pair[at] = -1
                        continue
                    new = lookup(ids[left] << SHIFT | ids[right], -1)
                    pair[left] = new
                    if new < 0:
                        continue
                    if new < rank:
                        irregular.add(at)  # an earlier merge has become possible: such a word is done alone
                    if new in index:
                        index[new].append(left)
                    else:
                        index[new] = [left]
                        heapq.heappush(heap, new)
                if far >= 0:
                    before[far] = at
        return ids, irregular

    def encode_alone(self, word: bytes) -> list[int]:
        """One word, always the lowest rank first, the leftmost of equals."""
        ids = [int(self.byte_ids[b]) for b in word]
        while len(ids) > 1:
            found = [self.pairs.get(a << SHIFT | b, -1) for a, b in zip(ids, ids[1:], strict=False)]
            possible = [r for r in found if r >= 0]
            if not possible:
                break
            at = found.index(min(possible))
            ids[at : at + 2] = [found[at]]
        return ids


class MatchCoder:
    """Encodes each match of the pattern separately; ids of up to ``most`` different matches are kept."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int = 400_000, chars: int = 4_000_000):
        self.ranks, self.matches, self.most, self.chars = ranks, regex.compile(pattern).findall, most, chars
        self.replay, self.known = MergeReplay(ranks), {}

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text as bytes; a missing text counts as empty. Texts of about ``chars`` are cut at a time."""
        found, some, size = [], [], 0
        for text in texts:
            some.append(text or "")
            size += len(some[-1])
            if size >= self.chars:
                found += self._encode(some)
                some, size = [], 0
        return found + self._encode(some)

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.matches(t) for t in texts]
        new = list(set().union(*cut) - self.known.keys())
        if len(self.known) + len(new) > self.most:
            self.known = {}
            new = list(set().union(*cut))
        plain = [w.encode() for w in new]
        # a match that is a token needs no merges
        whole = [self.ranks.get(w) for w in plain]
        self.known.update({w: to_bytes([r]) for w, r in zip(new, whole, strict=True) if r is not None})
        rest = [(w, p) for w, p, r in zip(new, plain, whole, strict=True) if r is None]
        self.known.update(zip([w for w, _ in rest], self.replay.encode([p for _, p in rest]), strict=True))
        return [b"".join(map(self.known.__getitem__, c)) for c in cut]


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the tokens, one after the other; they need not be valid UTF-8."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit numbers) of every whole text; null is empty."""

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = MatchCoder(read_ranks(path), pattern)
        for rows in batches:
            yield pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "ids": coder.encode(rows["text"])})

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(encoded, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the bytes that its ids stand for."""

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(read_ranks(path))
        for ids in batches:
            yield ids.map(decoder.decode)

    return encoded.withColumn("decoded", decoded("ids"))


def encoded_and_decoded(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no tokens and the digests of nothing. Rows without
    id keep a null id, repeated rows are encoded each, other columns are
    ignored, no documents give no rows.
    """
    both = decode(encode(documents, path, pattern), path)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
