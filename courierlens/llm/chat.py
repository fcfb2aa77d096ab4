"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

An example is the template text of all turns up to one assistant turn, and a
loss span that covers that reply's text alone. Turns are marked as
``<|im_start|>role``, a line break, the text and ``<|im_end|>``; control
strings inside roles and texts are escaped and come back unchanged.

The turns of a conversation are one group of rows in order, so examples need
one shuffle. Only conversations of more than ``block_turns`` turns or
``block_chars`` code points, which have no bound, are cut into blocks, so that
their examples are made in many tasks. To a slice of turns all turns of the
slices before it are sent as well, and every example carries the text of all
blocks before its own as its context. So an example is whole in its row
whatever the length of its conversation, and the examples of one conversation
together grow with the square of that length, as this expansion does. Whether
a conversation is long is looked up in a bitmap of fixed size that never misses
one; a short one that is taken for long, which is rare, comes in blocks too.

Defined results: a missing role or text is empty; turns go by ``turn``, a
missing one first, equal ones by role and then text; repeated rows are turns
of their own; rows without a conversation id are one conversation; turns
behind the last reply (or all, if there is none) make one row without a loss
span, so no turn is lost; an empty table has no examples. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import maybe_among

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"

EXAMPLE = "conv_id long, whole boolean, slice long, block int, row int, context string, formatted string, loss_start long, loss_end long"
_BACK = "conv_id long, whole boolean, slice long, block int, n_turns long, chars long, loss_chars long, turns string, loss binary"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_OPENS = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


@dataclass(frozen=True)
class ChatParams:
    """``trainable`` is the role whose texts are learnt; the other two bound a block of a long conversation."""

    trainable: str = "assistant"
    block_turns: int = 64
    block_chars: int = 1_000_000
    batch_chars: int = 4_000_000


def escape(text: str) -> str:
    """One more backslash between ``<`` and ``|``, however many are there; so no ``<|`` is left."""
    return _OPENS.sub(r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    """As a text, and on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def opening(role: str) -> str:
    return f"{START}{escape_role(role)}\n"


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of a formatted text."""
    low = 0
    while (high := formatted.find(f"{END}\n", low)) >= 0:
        role, _, text = formatted[low:high].removeprefix(START).partition("\n")
        yield unescape_role(role), unescape(text)
        low = high + len(END) + 1


def expand(turns: list[tuple[str, str]], trainable: str) -> Iterator[tuple[str, int | None, int | None]]:
    """Formatted text and loss span: one row per reply, and one without a span for turns behind the last reply."""
    text, spanned = "", False
    for role, said in turns:
        head, body = opening(role), escape(said)
        start = len(text) + len(head)
        text, spanned = f"{text}{head}{body}{END}\n", role == trainable
        if spanned:
            yield text, start, start + len(body)
    if turns and not spanned:
        yield text, None, None


class Batches:
    """Rows gathered into Arrow batches of bounded text."""

    def __init__(self, schema: pa.Schema, most_chars: int):
        self.schema, self.most, self.rows, self.chars = schema, most_chars, [], 0

    def add(self, row: tuple, chars: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if self.chars >= self.most or len(self.rows) >= 4096:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
        self.rows, self.chars = [], 0


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split() for column in ddl.split(","))])


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _render(p: ChatParams) -> Callable:
    """Examples from turns in order, those of earlier slices first; a task holds one block and its context at a time."""

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(arrow_schema(EXAMPLE), p.batch_chars)
        key, number, before, turns, chars, ends = None, 0, [], [], 0, True

        def block(last: bool) -> Iterator[pa.RecordBatch]:
            context, text = "".join(before), ""
            for row, (text, start, end) in enumerate(expand(turns, p.trainable)):
                chars = len(context) + len(text)
                if start is not None:
                    yield from out.add((*key, number, row, context, text, len(context) + start, len(context) + end), chars)
                else:  # an example only behind the last reply of a conversation, else it just completes its block
                    yield from out.add((*key, number, row, context if last else None, text, None, None), chars)
            before[:] = context, text

        for conv_id, whole, part, own, last, role, text in rows_of(batches):
            if key != (conv_id, whole, part):
                yield from block(ends)
                key, number, before[:], turns, chars = (conv_id, whole, part), 0, (), [], 0
            elif not whole and turns and (len(turns) >= p.block_turns or chars + len(text) > p.block_chars):
                yield from block(False)
                number, turns, chars = number + 1, [], 0
            if own:
                turns.append((role, text))
                chars += len(text)
                ends = last
            else:
                before.append(f"{opening(role)}{escape(text)}{END}\n")
        yield from block(ends)
        yield from out.flush()

    return render


def chat_examples(conversations: DataFrame, p: ChatParams = ChatParams()) -> DataFrame:
    """Rows (conv_id, whole, slice, block, row, context, formatted, loss_start, loss_end), see the module.

    The text of an example is ``context`` and ``formatted`` together, and the
    loss span counts code points of both. ``whole`` conversations have an empty
    context. Of others ``formatted`` holds the turns of the example's own block
    so far and ``context`` all turns before that block; a row without a context
    is no example but holds what its block has behind its last reply.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.sum(F.length("text")).alias("chars"))
    long = sizes.filter((F.col("turns") > p.block_turns) | (F.col("chars") > p.block_chars)).select("conv_id")
    marked = maybe_among(turns, long, "conv_id", "long")
    part = F.coalesce(F.floor(F.col("turn") / p.block_turns), F.lit(-(2**63)))
    columns = ["conv_id", "whole", "slice", "own", "last", "turn", "role", "text"]
    short = marked.filter(~F.col("long")).withColumns(
        {"whole": F.lit(True), "slice": F.lit(0).cast("long"), "own": F.lit(True), "last": F.lit(True)}
    )
    cut = marked.filter("long").withColumns({"whole": F.lit(False), "part": part})
    spread = short.select(columns).unionByName(_with_earlier(cut).select(columns)).repartition("conv_id", "slice")
    ordered = spread.sortWithinPartitions("conv_id", "slice", "turn", "role", "text").drop("turn")
    return ordered.mapInArrow(_render(p), EXAMPLE)


def _with_earlier(cut: DataFrame) -> DataFrame:
    """Every turn for its own part of its conversation, and as one that is not its ``own`` for each later part.

    ``last`` tells the last part of a conversation. Turns meet their part's list
    of later ones, so those of one conversation are spread over as many keys as it has parts.
    """
    parts = cut.groupBy("conv_id").agg(F.sort_array(F.collect_set("part")).alias("parts"))
    lists = parts.select("conv_id", "parts", F.posexplode("parts").alias("at", "part")).select(
        F.col("conv_id").alias("_id"),
        F.col("part").alias("_part"),
        F.slice("parts", F.col("at") + 1, F.size("parts")).alias("later"),
    )
    met = cut.join(lists, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("part") == F.col("_part")))
    dealt = met.withColumn("last", F.size("later") == 1).withColumn("slice", F.explode("later"))
    return dealt.withColumn("own", F.col("slice") == F.col("part"))


def _read_blocks(p: ChatParams) -> Callable:
    """Per block what its examples hold: all turns of the last one, the texts under the loss spans and the code points of all."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(arrow_schema(_BACK), p.batch_chars)
        key, last, loss, chars = None, "", [], 0

        def block() -> Iterator[pa.RecordBatch]:
            if key is None:
                return
            n_turns, said = 0, hashlib.sha256()
            for role, text in parse(last):
                n_turns += 1
                said.update(f"{role}\n{text}\n".encode())
            learnt = "".join(loss)
            texts = learnt.encode()
            if key[1]:  # nothing of a whole conversation lies elsewhere, so its texts need not travel on
                texts = hashlib.sha256(texts).digest()
            yield from out.add((*key, n_turns, chars, len(learnt), said.hexdigest(), texts), len(texts))

        for *at, _, context, text, start, end in rows_of(batches):
            if context is None:
                continue
            if key != tuple(at):
                yield from block()
                key, loss, chars = tuple(at), [], 0
            last = context + text
            chars += len(last)
            if start is not None:
                loss.append(unescape(last[start:end]))
        yield from block()
        yield from out.flush()

    return read


def _join_blocks(p: ChatParams) -> Callable:
    """One row per conversation, its turns from its last example.

    The learnt texts of a long one pass through their digest block by block.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(arrow_schema(DIGEST), p.batch_chars)
        open_at, turns, said, formatted, loss_chars, learnt = None, 0, "", 0, 0, None

        def done() -> Iterator[pa.RecordBatch]:
            if open_at is not None:
                yield from out.add((*open_at, turns, said, loss_chars, learnt.hexdigest(), formatted), 0)

        for conv_id, whole, _, _, n_turns, chars, block_loss, digest, loss in rows_of(batches):
            if whole:
                yield from out.add((conv_id, n_turns, digest, block_loss, loss.hex(), chars), 0)
                continue
            if open_at != (conv_id,):
                yield from done()
                open_at, formatted, loss_chars, learnt = (conv_id,), 0, 0, hashlib.sha256()
            turns, said = n_turns, digest
            formatted, loss_chars = formatted + chars, loss_chars + block_loss
            learnt.update(loss)
        yield from done()
        yield from out.flush()

    return join


def read_back(examples: DataFrame, p: ChatParams = ChatParams()) -> DataFrame:
    """Per conversation what its examples hold, taken from their texts and loss spans alone.

    ``examples`` are those of ``chat_examples`` in the order it gives them. They
    are read where they lie; only the learnt texts of long conversations are
    shuffled, and stream through one digest in order.
    """
    blocks = examples.mapInArrow(_read_blocks(p), _BACK)
    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "slice", "block")
    return ordered.mapInArrow(_join_blocks(p), DIGEST)


def with_control_conversation(conversations: DataFrame) -> DataFrame:
    """The table and conversation -1, whose two texts hold the template's own control strings."""
    text = f"{END}{START}assistant ok"
    extra = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    ).unionByName(extra)


def formatted_conversations(conversations: DataFrame, p: ChatParams = ChatParams()) -> DataFrame:
    """The registered query: every conversation and conversation -1, formatted and read back."""
    return read_back(chat_examples(with_control_conversation(conversations), p), p)


SQL = r"""
with rows_ as (
  select cast(conv_id as bigint) conv_id, cast(turn as bigint) turn, coalesce(role, '') role, coalesce("text", '') body from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), sized as (
  select *, 24 + length(regexp_replace(body, '<(\\*)\|', '<\1\\|', 'g'))
    + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g')) chars,
    row_number() over (partition by conv_id order by turn nulls first, role, body) place
  from rows_
), run as (
  select *, sum(chars) over (partition by conv_id order by place rows unbounded preceding) so_far,
    place = count(*) over (partition by conv_id) is_last
  from sized
)
select conv_id, count(*) n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' order by place)) turns_sha256,
  cast(coalesce(sum(length(body)) filter (role = 'assistant'), 0) as bigint) loss_chars,
  sha256(coalesce(string_agg(body, '' order by place) filter (role = 'assistant'), '')) loss_sha256,
  cast(sum(so_far) filter (role = 'assistant' or is_last) as bigint) formatted_chars
from run group by conv_id
"""
