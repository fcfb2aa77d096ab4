"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``order``, learnt from the training
documents and held as tables: per context of each length the counts of the
bytes that followed it. A byte is coded in the longest context that has seen it;
from each longer one the coder escapes, with the probability that as many novel
events as the context has distinct bytes would have (method C), and bytes the
longer context could have coded are excluded from the shorter ones.

With the model fixed, the code length of a byte depends on its ``order``
preceding bytes alone. So Spark works it out once per distinct (order + 1)-gram
of the corpus, by joins down the trie, and not once per byte. Documents then
meet only the grams and words of their block: a block is what one task has
read, ``block_rows`` documents at most, and is written with the documents. So its
dictionary is bounded by the split size and no table of the whole corpus is
ever in one place. A document's text moves through one shuffle.

Texts are scored as their words (A-Z in lower case), joined by one blank, and an
end. \\x09 stands before the start and \\x0A for the end; words hold neither.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import fold, written


@dataclass(frozen=True)
class PpmParams:
    order: int = 5
    folds: int = 7
    held_out: int = 2
    block_rows: int = 50_000


END = b""
SYMBOLS = 256
PIECE = 1 << 18  # bytes of a text packed at a time
SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


def words_of(text: str | None) -> list[bytes]:
    """bytes.split() cuts at exactly \\x20 and \\x09-\\x0D."""
    return text.encode().lower().split() if text else []


def grams_of(words: list[bytes], order: int) -> Iterator[np.ndarray]:
    """Packed (order + 1)-grams, one for each byte of the text and its end, in pieces; the last byte is the coded one."""
    stream = np.frombuffer(b"\x09" * order + b" ".join(words) + b"\x0a", np.uint8)
    size = len(stream) - order
    for start in range(0, size, PIECE):
        end = min(start + PIECE, size)
        packed = np.zeros(end - start, np.int64)
        for i in range(order + 1):
            packed <<= 8
            packed |= stream[start + i : end + i]
        yield packed


class GramCounts:
    """Counts by gram; new ones are summed up in small lots, and lots merged when they outweigh what is merged."""

    def __init__(self, lot: int = 1_000_000):
        self.lot, self.fresh, self.waiting, self.lots = lot, [], 0, []

    def add(self, grams: np.ndarray, weight: int) -> None:
        """``weight`` is 0 or 1; as the last bit it is sorted along with the gram."""
        self.fresh.append(grams << 1 | weight)
        self.waiting += len(grams)
        if self.waiting >= self.lot:
            self.close_lot()

    def close_lot(self) -> None:
        """Like a binary counter: a lot takes in every earlier one that is not larger, so a gram is moved few times."""
        if not self.fresh:
            return
        marked = np.sort(np.concatenate(self.fresh))
        self.fresh, self.waiting = [], 0
        new = self.counted(marked >> 1, marked & 1)
        while self.lots and len(self.lots[-1][0]) <= 2 * len(new[0]):
            new = self.summed([self.lots.pop(), new])
        self.lots.append(new)

    @staticmethod
    def counted(grams: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Grams in order, each once, with the sum of its weights."""
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        return grams[first], np.add.reduceat(weights, first, dtype=np.int64)

    @classmethod
    def summed(cls, parts: list) -> tuple[np.ndarray, np.ndarray]:
        grams, weights = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(grams, kind="stable")  # runs in order are merged
        return cls.counted(grams[order], weights[order])

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        self.close_lot()
        if not self.lots:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        while len(self.lots) > 1:
            self.lots.append(self.summed([self.lots.pop(), self.lots.pop()]))
        return self.lots[0]


def _tallied(params: PpmParams):
    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def result(block: int) -> Iterator[pd.DataFrame]:
            values, counts = grams.merge()
            for start in range(0, len(values), 100_000):
                some = slice(start, start + 100_000)
                yield pd.DataFrame({"block": block, "gram": values[some], "word": None, "n": counts[some]})
            found = list(words)
            for start in range(0, len(found), 100_000):
                some = found[start : start + 100_000]
                yield pd.DataFrame({"block": block, "gram": 0, "word": some, "n": [words[w] for w in some]})

        now, grams, words = None, GramCounts(), Counter()
        for rows in batches:
            for block, held, text in zip(rows["block"], rows["held_out"], rows["text"], strict=True):
                if block != now:
                    if now is not None:
                        yield from result(now)
                    now, grams, words = block, GramCounts(), Counter()
                tokens = words_of(text)
                for piece in grams_of(tokens, params.order):
                    grams.add(piece, 0 if held else 1)
                tokens.append(END)
                if held:
                    for token in tokens:
                        words.setdefault(token, 0)
                else:
                    words.update(tokens)
        if now is not None:
            yield from result(now)

    return tally


def byte_costs(grams: DataFrame, params: PpmParams) -> DataFrame:
    """(gram, cost): log10 probability of the last byte after the others, for all rows of grams (gram, n).

    ``n`` counts the training text and may be 0. From the longest context down,
    grams not seen there go on with the escape added up, without the counts of
    the bytes that the longer context has seen.
    """
    order = params.order

    def suffix(column: str, length: int) -> Column:
        return F.col(column).bitwiseAND(F.lit((1 << 8 * length) - 1))

    tries = {order: grams.filter("n > 0").select("gram", "n")}
    for k in range(order - 1, -1, -1):
        shorter = tries[k + 1].groupBy(suffix("gram", k + 1).alias("gram")).agg(F.sum("n").alias("n"))
        tries[k] = written(shorter, f"ppm-{k}")

    def contexts(k: int) -> DataFrame:
        """Per context: symbols in all, distinct ones, and how often the next shorter context saw these."""
        own = tries[k].withColumn("context", F.shiftright("gram", 8))
        if k == 0:
            own = own.withColumn("m", F.lit(0).cast("bigint"))
        else:
            below = tries[k - 1].select(F.col("gram").alias("short"), F.col("n").alias("m"))
            own = own.join(below, suffix("gram", k) == F.col("short"))
        return own.groupBy("context").agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.sum("m").alias("excluded")
        )

    zero = F.lit(0).cast("bigint")
    left = grams.select("gram", "n", F.lit(0.0).alias("cost"), zero.alias("less"), zero.alias("fewer"))
    done = []
    for k in range(order, -1, -1):
        if k < order:
            seen = tries[k].select(F.col("gram").alias("tail"), "n")
            left = left.join(seen, suffix("gram", k + 1) == F.col("tail"), "left").drop("tail")
        known = left.join(contexts(k), F.shiftright(suffix("gram", k + 1), 8) == F.col("context"), "left").drop("context")
        total, kinds = F.col("total") - F.col("less"), F.col("kinds") - F.col("fewer")
        hit = F.log10(F.col("n") / (total + kinds))
        escape = F.when(kinds > 0, F.log10(kinds / (total + kinds))).otherwise(0.0)
        priced = written(
            known.select(
                "gram",
                (F.coalesce("n", F.lit(0)) > 0).alias("found"),
                (F.col("cost") + F.when(F.coalesce("n", F.lit(0)) > 0, hit).otherwise(F.coalesce(escape, F.lit(0.0)))).alias("cost"),
                F.coalesce("excluded", zero).alias("less"),
                F.coalesce("kinds", zero).alias("fewer"),
            ),
            f"ppm-priced-{k}",
        )
        done.append(priced.filter("found").select("gram", "cost"))
        left = priced.filter("not found").select("gram", "cost", "less", "fewer")
    # a byte no training text has: all bytes not seen are equally likely
    novel = F.log10(F.lit(1.0) / (F.lit(SYMBOLS) - F.col("fewer")))
    result = left.select("gram", (F.col("cost") + novel).alias("cost"))
    for frame in done:
        result = result.union(frame)
    return result


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of keys, which are in order, for wanted ones in any; one that is missing is an error."""
    order = np.argsort(wanted)
    ordered = wanted[order]
    places = np.searchsorted(keys, ordered)  # in order, so neighbours lie close together
    if len(wanted) and (places[-1] >= len(keys) or (keys[places] != ordered).any()):
        raise ValueError("a text holds a gram that its block does not know")
    found = np.empty(len(wanted))
    found[order] = values[places]
    return found


class CodeLengths:
    """Sums of byte costs by text; the bytes of many texts are looked up together."""

    def __init__(self, grams: np.ndarray, costs: np.ndarray, lot: int = 500_000):
        self.grams, self.costs, self.lot = grams, costs, lot
        self.sums: list[float] = []
        self.pieces, self.owners, self.waiting = [], [], 0

    def add(self, pieces: Iterator[np.ndarray]) -> None:
        """The next text."""
        self.sums.append(0.0)
        for piece in pieces:
            self.pieces.append(piece)
            self.owners.append(len(self.sums) - 1)
            self.waiting += len(piece)
            if self.waiting >= self.lot:
                self.close_lot()

    def close_lot(self) -> None:
        if not self.pieces:
            return
        starts = np.concatenate([[0], np.cumsum([len(p) for p in self.pieces])])
        costs = looked_up(self.grams, self.costs, np.concatenate(self.pieces))
        for owner, first, end in zip(self.owners, starts, starts[1:], strict=False):
            self.sums[owner] += float(costs[first:end].sum())
        self.pieces, self.owners, self.waiting = [], [], 0


def _scored(params: PpmParams, total: int, distinct: int):
    def score(docs: pa.Table, entries: pa.Table) -> pa.Table:
        # columns of a block stay as they came; only a few texts at a time become Python's
        is_word = pc.is_valid(entries["word"])
        words = entries.filter(is_word)
        counts = dict(zip(words["word"].to_pylist(), words["value"].to_pylist(), strict=True))
        grams = entries.filter(pc.invert(is_word)).select(["gram", "value"])
        del words, entries
        order = np.argsort(keys := grams["gram"].to_numpy())
        codes = CodeLengths(keys[order], grams["value"].to_numpy()[order])
        del grams, keys, order
        found = []
        for batch in docs.select(["doc_id", "held_out", "text"]).to_batches(max_chunksize=64):
            for doc_id, held, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = words_of(text)
                codes.add(grams_of(tokens, params.order))
                tokens.append(END)
                c = np.fromiter(map(counts.__getitem__, tokens), float, len(tokens))
                base = float(np.log10((c + 1) / (total + distinct + 1)).sum())
                found.append((doc_id, held, len(tokens), int((c > 0).sum()), total, base))
        codes.close_lot()
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        columns = [*zip(*found, strict=True), codes.sums] if found else [()] * len(kinds)
        names = [c.split()[0] for c in SCORED.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return score


def scores(documents: DataFrame, params: PpmParams = PpmParams()) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts consist of their end alone. A row without id counts as
    training text. Repeated rows are learnt from and scored each; other columns
    are ignored; no documents give no rows. Without training text every byte
    has the same probability and train_tokens is 0. No text is cut, and every
    gram and word of the training documents counts, at any size.
    """
    held = F.coalesce(fold("doc_id", params.folds) == params.held_out, F.lit(False))
    # written once with its block, so both passes agree whatever becomes of executors and splits in between
    number = F.monotonically_increasing_id()
    place = F.floor(number.bitwiseAND(F.lit((1 << 33) - 1)) / params.block_rows)
    docs = written(
        documents.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            "text",
            held.alias("held_out"),
            F.shiftleft(F.shiftright(number, 33), 32).bitwiseOR(place).alias("block"),
        ),
        "ppm-documents",
    )
    tallies = docs.select("block", "held_out", "text").mapInPandas(
        _tallied(params), "block bigint, gram bigint, word binary, n bigint"
    )
    known = written(
        tallies.groupBy("gram", "word").agg(F.sum("n").alias("n"), F.collect_list("block").alias("blocks")), "ppm-known"
    )
    words = known.filter("word is not null")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.when(F.col("n") > 0, 1)).alias("kinds")).first()
    grams = known.filter("word is null")
    costs = byte_costs(grams.select("gram", "n"), params)
    priced = grams.select("gram", "word", "blocks").join(costs, "gram").select("gram", "word", F.col("cost").alias("value"), "blocks")
    entries = priced.union(words.select("gram", "word", F.col("n").cast("double"), "blocks")).select(
        F.explode("blocks").alias("block"), "gram", "word", "value"
    )
    return (
        docs.groupBy("block")
        .cogroup(entries.groupBy("block"))
        .applyInArrow(_scored(params, int(sums["total"]), int(sums["kinds"])), SCORED)
    )
