"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A document is its set of distinct word shingles; documents with
100 * intersection >= threshold * union are linked.

1. Documents with equal sets fall into one class, so copies cost one row each.
2. A class has ``slots`` MinHash values of 16 bits. Its signature is split into
   chunks of ``chunk`` slots. Two signatures that differ in at most
   chunks * (errors + 1) - 1 slots have, by the pigeonhole principle, a chunk
   with at most ``errors`` differences; every choice of slots to leave out of a
   chunk gives a key, and such a pair shares one of these keys for certain.
   Pairs further apart are mostly found too: at similarity 0.8 the chance that
   no chunk is close enough is 2.4e-5 with the default parameters.
3. All classes that share a key share that key's smallest class, its hub. The
   classes met through one hub are compared in a grid of blocks, so a hub with
   many classes is spread over many tasks and no pair is written out. A first
   pass compares signatures and lets go of classes without a close one, a
   second one compares the full sets and gives back a spanning forest of the
   links found in its block.
4. Components of these links are the groups.

The number of comparisons still grows with the square of the number of
different texts that share a key with one hub; copies do not count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import Cache, connected, maybe_among, written


@dataclass(frozen=True)
class NearParams:
    words: int = 5
    threshold: int = 80
    chunks: int = 10
    chunk: int = 6
    errors: int = 1
    apart: int = 26  # slots; 4.5 standard deviations beyond the mean at the threshold
    block: int = 512
    seed: int = 20_240_601

    @property
    def slots(self) -> int:
        return self.chunks * self.chunk


ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def shingle_set(text: str | None, words: int, hashes: Cache) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of the whole text, A-Z in lower case."""
    # bytes.split() cuts at exactly \x20 and \x09-\x0D
    found = text.encode().lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if len(h) < words:
        return np.array([word_hash(b"\n".join(found))], np.uint64)
    rolled = np.zeros(len(h) - words + 1, np.uint64)
    for i in range(words):
        rolled = mixed(rolled + h[i : len(h) - words + 1 + i] * np.uint64(2 * i + 3))
    return np.unique(rolled)


def slot_factors(params: NearParams) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(params.seed)
    factors = random.integers(0, 2**63, params.slots, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors[:, None], random.integers(0, 2**63, params.slots, dtype=np.uint64)[:, None]


def signature(shingles: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """16 bits of the least hash per slot."""
    least = np.full(len(factors[0]), 2**64 - 1, np.uint64)
    for start in range(0, len(shingles), 4096):
        least = np.minimum(least, (factors[0] * shingles[start : start + 4096] + factors[1]).min(axis=1))
    return (mixed(least) >> np.uint64(48)).astype("<u2")


def chunk_keys(signatures: np.ndarray, params: NearParams) -> np.ndarray:
    """All keys of each signature: per chunk one for every choice of ``errors`` slots left out."""
    keys = []
    for chunk in range(params.chunks):
        slots = range(chunk * params.chunk, (chunk + 1) * params.chunk)
        for left_out in combinations(slots, params.errors):
            key = np.full(len(signatures), hash((chunk, left_out)) & (2**63 - 1), np.uint64)
            for slot in slots:
                if slot not in left_out:
                    key = mixed(key * np.uint64(65_537) + signatures[:, slot].astype(np.uint64) + np.uint64(1))
            keys.append(key)
    return np.stack(keys, 1).view(np.int64)


def _signed(params: NearParams):
    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, factors = Cache(word_hash), slot_factors(params)
        for rows in batches:
            sets = [shingle_set(t, params.words, hashes) for t in rows["text"]]
            digests = [xxhash.xxh128_digest(s.tobytes()) if len(s) else b"\0" * 16 for s in sets]
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pd.DataFrame(
                {
                    "doc_id": rows["doc_id"].astype("Int64"),
                    "n_shingles": [len(s) for s in sets],
                    "high": halves[:, 0],
                    "low": halves[:, 1],
                    "signature": [signature(s, factors).tobytes() if len(s) else None for s in sets],
                }
            )

    return signed


def _keyed(params: NearParams):
    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                signatures = np.frombuffer(b"".join(rows["signature"]), "<u2").reshape(len(rows), -1)
                keys = chunk_keys(signatures, params)
                yield pd.DataFrame({"key": keys.ravel(), "rep": np.repeat(rows["rep"].to_numpy(), keys.shape[1])})

    return keyed


def in_cells(members: DataFrame, block: int) -> DataFrame:
    """Deal the members (hub, rep) of each hub into the cells of a grid of blocks, each cell into one bin.

    A hub's members fall into blocks of about ``block``; a member goes to every
    pair of blocks that has its own, so each two members meet in some cell.
    """
    sizes = members.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = (
        members.join(sizes, "hub")
        .withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks").cast("bigint") - 1)))
    )
    cell = F.xxhash64("hub", F.least("mine", "other"), F.greatest("mine", "other"))
    return dealt.select("rep", cell.alias("cell"), "hub").drop("hub")


def _groups(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    order = np.argsort(rows["cell"].to_numpy(), kind="stable")
    cells = rows["cell"].to_numpy()[order]
    for places in np.split(order, np.flatnonzero(np.diff(cells)) + 1):
        if len(places) > 1:
            yield rows.iloc[places]


def _close_of(params: NearParams):
    def close(rows: pd.DataFrame) -> pd.DataFrame:
        kept = []
        for cell in _groups(rows):
            signatures = np.frombuffer(b"".join(cell["signature"]), "<u2").reshape(len(cell), -1)
            near = np.zeros(len(cell), bool)
            for i in range(len(cell) - 1):
                here = (signatures[i + 1 :] != signatures[i]).sum(axis=1) <= params.apart
                near[i + 1 :] |= here
                near[i] |= here.any()
            kept.append(cell.loc[near, ["cell", "rep"]])
        return pd.concat(kept) if kept else rows.iloc[:0][["cell", "rep"]]

    return close


def shared_counts(sets: list[np.ndarray], columns: int = 16_384) -> np.ndarray:
    """Sizes of all intersections, from the shingles that occur twice or more, some columns at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1
    often = times[number] > 1
    owner, number = owner[often], rank[number[often]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int((times > 1).sum()), columns):
        low, high = np.searchsorted(number, [start, start + columns])
        present = np.zeros((len(sets), columns), np.float32)
        present[owner[low:high], number[low:high] - start] = 1
        counts += present @ present.T
    return counts


def _linked_of(params: NearParams):
    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for cell in _groups(rows):
            sets = [np.frombuffer(s, np.uint64) for s in cell["shingles"]]
            sizes = np.array([len(s) for s in sets])
            both = shared_counts(sets).astype(np.int64)
            union = sizes[:, None] + sizes[None, :] - both
            links = 100 * both >= params.threshold * union
            np.fill_diagonal(links, False)
            reps = cell["rep"].to_numpy()
            found += [(reps[i], reps[j]) for i, j in forest(links)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return linked


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of an adjacency matrix, found breadth first."""
    left, edges = np.ones(len(links), bool), []
    for root in range(len(links)):
        if not left[root]:
            continue
        left[root], front = False, [root]
        while front:
            at = front.pop()
            new = np.flatnonzero(links[at] & left)
            left[new] = False
            edges += [(at, int(n)) for n in new]
            front += new.tolist()
    return edges


def _sets_of(params: NearParams):
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Cache(word_hash)
        for rows in batches:
            found = [shingle_set(t, params.words, hashes).tobytes() for t in rows["text"]]
            yield pd.DataFrame({"rep": rows["doc_id"], "shingles": found})

    return sets


def near_links(documents: DataFrame, classes: DataFrame, params: NearParams) -> DataFrame:
    """Links (a, b) between class representatives: enough of them to span every group."""
    keys = classes.mapInPandas(_keyed(params), "key bigint, rep bigint")
    hubs = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).filter("hub < last")
    met = keys.join(hubs.select("key", "hub"), "key").groupBy("hub", "rep").agg(F.lit(0).alias("_")).drop("_")
    cells = written(in_cells(met, params.block), "near-cells")
    bins = max(1, cells.count() // (4 * params.block))
    binned = F.pmod(F.col("cell"), F.lit(bins)).alias("bin")
    close = written(
        cells.join(classes.select("rep", "signature"), "rep")
        .select(binned, "cell", "rep", "signature")
        .groupBy("bin")
        .applyInPandas(_close_of(params), "cell bigint, rep bigint"),
        "near-close",
    )
    wanted = close.select(F.col("rep").alias("doc_id")).distinct()
    # texts of classes that are alone are left out before the join, so only candidates' texts are shuffled
    likely = maybe_among(documents.select("doc_id", "text"), wanted, "doc_id", "_maybe").filter("_maybe").drop("_maybe")
    sets = written(
        likely.join(wanted, "doc_id", "left_semi").mapInPandas(
            _sets_of(params), "rep bigint, shingles binary"
        ),
        "near-sets",
    )
    return (
        close.join(sets, "rep")
        .select(binned, "cell", "rep", "shingles")
        .groupBy("bin")
        .applyInPandas(_linked_of(params), "a bigint, b bigint")
    )


def near_duplicates(documents: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (doc_id = component_id).

    Texts that are null, empty or without words have no shingles and link with
    nothing. Rows that repeat an id are one document for the links, each with
    its own count. A row without id links with nothing, its component is null
    and it is kept. Ties go to the smallest id; other columns are ignored; no
    documents give no rows.
    """
    documents = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = written(
        documents.mapInPandas(
            _signed(params), "doc_id bigint, n_shingles bigint, high bigint, low bigint, signature binary"
        ),
        "near-signed",
    )
    known = signed.filter("doc_id is not null and n_shingles > 0")
    classes = written(
        known.groupBy("n_shingles", "high", "low")
        .agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
        .select("n_shingles", "high", "low", "rep", "signature"),
        "near-classes",
    )
    copies = known.join(classes.drop("signature"), ["n_shingles", "high", "low"]).filter("doc_id <> rep")
    links = near_links(documents, classes, params).union(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    labels = connected(links.filter("a <> b").distinct(), "near-components")
    return (
        signed.select("doc_id", "n_shingles")
        .join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)).alias("kept"))
    )


def keep_one(documents: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Rows that repeat an id are one document; of them the one with the least
    text stays, a missing text before all, and of equal texts any. Rows without
    an id link with nothing and all stay, as do texts without words. Columns
    may have any names; no documents give none.
    """
    rows = near_duplicates(documents, params).filter("doc_id is not null")
    ids = rows.groupBy("doc_id").agg(F.max("kept").alias("stays"), (F.count(F.lit(1)) > 1).alias("repeats"))
    special = written(ids.filter("not stays or repeats").withColumnRenamed("doc_id", "id"), "near-special")
    # a row travels as one column, so its own names meet none of these
    packed = documents.select(
        F.col("doc_id").cast("bigint").alias("key"), F.col("text").alias("said"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    )
    # most rows are neither dropped nor repeated: they pass without a shuffle
    marked = maybe_among(packed, special.select(F.col("id").alias("key")), "key", "maybe")
    looked_at = marked.filter("maybe").join(special, F.col("key") == F.col("id"), "left")
    single = looked_at.filter("id is null")
    several = looked_at.filter("stays and repeats").groupBy("key").agg(F.min_by("row", F.struct("said")).alias("row"))
    return marked.filter("not maybe").select("row").unionByName(single.select("row")).unionByName(several.select("row")).select("row.*")
