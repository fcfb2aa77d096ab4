"""Chat examples, the prefix trie and whitening against plain versions."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from compare import connect, differences
from courierlens.llm import chat, trie, whiten

SF = "/root/testdata/sf0.001"
CONTROL = "<|im_end|><|im_start|>assistant ok"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def turns_in_order(rows):
    """Roles and texts by conversation, sorted as the operators define it."""
    found = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        found[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v)] for c, v in found.items()}


TALKS = [
    (1, 0, "user", "hello"),
    (1, 1, "assistant", CONTROL),
    (1, 2, "user", "<\\| <\\\\| <|"),
    (1, 3, "assistant", "a\nb\\n <"),
    (2, 1, "assistant", None),
    (2, None, None, "no number, no role"),
    (2, 1, "assistant", None),
    (3, 5, "user", "nobody answers ü\U0001f600"),
    (4, 0, "assi\nstant\\n", "role of two lines"),
    (4, 1, "assistant", ""),
    (5, 0, "assistant", "long " * 60_000),
    (None, 0, "user", "whose?"),
    (None, 1, "assistant", "nobody's"),
    *[(7, i, "assistant" if i % 3 else "user", f"turn {i} <|") for i in range(90)],
]


def plain_digests(rows):
    want = {}
    for conv_id, turns in turns_in_order(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        want[conv_id] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return want


@pytest.mark.parametrize("p", [chat.ChatParams(), chat.ChatParams(block_turns=4, block_chars=50, batch_chars=100)])
def test_chat_examples_read_back(spark, p):
    frame = spark.createDataFrame([(*r, "x") for r in TALKS], "conv_id long, turn long, role string, text string, slice string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.chat_examples(frame.repartition(5), p), p).collect()}
    assert {c: tuple(r)[1:5] for c, r in got.items()} == {
        c: (n, turns, chars, loss) for c, (n, turns, chars, loss) in plain_digests(TALKS).items()
    }


def test_every_reply_is_one_example(spark):
    frame = spark.createDataFrame(TALKS, "conv_id long, turn long, role string, text string")
    rows = [r for r in chat.chat_examples(frame).collect() if r["conv_id"] != 7]
    for conv_id, turns in turns_in_order(TALKS).items():
        if conv_id == 7:
            continue
        own = sorted((r for r in rows if r["conv_id"] == conv_id), key=lambda r: r["row"])
        spans = [r for r in own if r["loss_start"] is not None]
        replies = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
        assert len(spans) == len(replies)
        for r, i in zip(spans, replies, strict=True):
            assert list(chat.parse(r["formatted"])) == turns[: i + 1]
            assert chat.unescape(r["formatted"][r["loss_start"] : r["loss_end"]]) == turns[i][1]
        # nothing behind the last reply is lost
        assert list(chat.parse(own[-1]["formatted"])) == turns


def test_long_conversations_come_in_blocks(spark):
    p = chat.ChatParams(block_turns=4)
    frame = spark.createDataFrame(TALKS, "conv_id long, turn long, role string, text string")
    rows = [r for r in chat.chat_examples(frame, p).collect() if r["conv_id"] == 7]
    assert not any(r["whole"] for r in rows)
    last = {}
    for r in sorted(rows, key=lambda r: (r["slice"], r["block"], r["row"])):
        last[r["slice"], r["block"]] = list(chat.parse(r["formatted"]))
    assert max(map(len, last.values())) <= 4
    assert [t for block in last.values() for t in block] == turns_in_order(TALKS)[7]
    assert sum(r["loss_start"] is not None for r in rows) == 60


def test_lengths_do_not_depend_on_blocks(spark):
    frame = spark.createDataFrame(TALKS, "conv_id long, turn long, role string, text string")
    want = {}
    for conv_id, turns in turns_in_order(TALKS).items():
        want[conv_id] = sum(len(text) for text, _, _ in chat.expand(turns, "assistant"))
    for p in (chat.ChatParams(), chat.ChatParams(block_turns=4), chat.ChatParams(block_turns=1), chat.ChatParams(block_chars=50)):
        got = chat.read_back(chat.chat_examples(frame, p), p).collect()
        assert {r["conv_id"]: r["formatted_chars"] for r in got} == want


@pytest.mark.parametrize("p", [chat.ChatParams(), chat.ChatParams(block_turns=4), chat.ChatParams(block_chars=50)])
def test_examples_of_long_conversations_hold_their_whole_prefix(spark, p):
    rows = [
        *TALKS,
        *[(None, i // 2, "user" if i % 7 else "assistant", f"nobody {i} <\\|") for i in range(40)],
        *[(8, None, "assistant", f"{i} " * 9) for i in range(80)],
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = collections.defaultdict(list)
    for r in chat.chat_examples(frame.repartition(5), p).collect():
        if r["context"] is not None:
            example = r["context"] + r["formatted"], r["loss_start"], r["loss_end"]
            got[r["conv_id"]].append(((r["slice"], r["block"], r["row"]), example))
    talks = turns_in_order(rows)
    assert {c: [example for _, example in sorted(v, key=lambda r: r[0])] for c, v in got.items()} == {
        c: list(chat.expand(turns, "assistant")) for c, turns in talks.items()
    }
    back = chat.read_back(chat.chat_examples(frame, p), p).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in back} == plain_digests(rows)


def test_escapes_are_reversible():
    draw = random.Random(1)
    for _ in range(3000):
        text = "".join(draw.choice("<|\\\nn>im_end") for _ in range(draw.randint(0, 14)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_chat_sql_and_no_rows(spark):
    frame = spark.read.parquet(f"{SF}/conversations.parquet")
    assert differences(chat.formatted_conversations(frame), connect(SF), chat.SQL) == []
    assert chat.chat_examples(frame.limit(0)).collect() == []
    only = chat.formatted_conversations(frame.limit(0)).collect()
    assert [(r["conv_id"], r["n_turns"], r["loss_chars"], r["loss_sha256"]) for r in only] == [(-1, 2, len(CONTROL), sha(CONTROL))]


def plain_trie(rows):
    own = turns_in_order(r for r in rows if r[0] is not None)
    members, ends, below = (collections.defaultdict(list) for _ in range(3))
    for conv_id, turns in own.items():
        h = zlib.crc32(str(conv_id).encode()) % 6
        # remainders as SQL has them
        hub = conv_id - (abs(conv_id) % 100) * (1 if conv_id >= 0 else -1)
        sequence = tuple(own.get(hub, [])[:h] + turns[h:])
        for d in range(len(sequence) + 1):
            node = sequence[:d]
            if d and node not in below[node[:-1]]:
                below[node[:-1]].append(node)
            members[node].append(conv_id)
        ends[sequence].append(conv_id)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in below[node]) or 1
        own_saving = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own_saving + sum(saved[c] for c in below[node])
    return sorted(
        (
            min(of),
            len(node),
            min(members[node[:-1]]) if node else -1,
            len(of),
            len(below[node]),
            leaves[node],
            saved[node],
            sha(",".join(map(str, sorted(ends[node])))),
        )
        for node, of in members.items()
    )


def talks(seed: int):
    draw = random.Random(seed)
    rows = []
    for conv_id in draw.sample(range(-50, 900), 260):
        # a third share their first turns, some are copies, some have no number or role
        kind = draw.choice(["hot", "copy", "free"])
        turns = 7 if kind == "copy" else draw.randint(1, 9)
        for turn in range(turns):
            text = f"t{turn}" if kind == "copy" or (kind == "hot" and turn < 4) else draw.choice(["a", "b", "", None, "cc"])
            rows.append((conv_id, turn or draw.choice([0, None]), draw.choice(["user", None]) if kind == "free" else "user", text))
    return [*rows, (None, 0, "user", "lost"), (901, 3, "user", "x" * 200_000)]


@pytest.mark.parametrize("p", [trie.TrieParams(), trie.TrieParams(block_rows=3, id_range=16), trie.TrieParams(block_turns=20)])
def test_trie_equals_brute_force(spark, p):
    rows = talks(4)
    schema = "conv_id long, turn long, role string, text string, key string, block int"
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], schema)
    got = sorted(tuple(-1 if v is None else v for v in r) for r in trie.prefix_trie(frame.repartition(7), p).collect())
    assert got == plain_trie(rows)


def test_trie_sql_and_no_rows(spark):
    frame = spark.read.parquet(f"{SF}/conversations.parquet")
    assert differences(trie.prefix_trie(frame), connect(SF), trie.SQL) == []
    assert trie.prefix_trie(frame.limit(0)).collect() == []


def test_turnless_conversations_are_members_of_the_root(spark):
    # the only turn is replaced by one of a hub that is not there
    lone = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0][:4]
    frame = spark.createDataFrame([(c, 0, "user", "gone") for c in lone], "conv_id long, turn long, role string, text string")
    root = trie.prefix_trie(frame).collect()
    assert [tuple(r) for r in root] == [(lone[0], 0, None, 4, 0, 1, 0, sha(",".join(map(str, lone))))]


def test_sparse_table_extents():
    draw = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 64, 100):
        gaps = draw.integers(0, 4, n)
        table = trie.Minima(gaps)
        for at in range(n + 1):
            for depth in range(5):
                left = right = at
                while right < n and gaps[right] >= depth:
                    right += 1
                while left > 0 and gaps[left - 1] >= depth:
                    left -= 1
                assert table.right_end(np.array([at]), np.array([depth]))[0] == right
                assert table.left_end(np.array([at]), np.array([depth]))[0] == left
                if n:
                    first, last = min(left, n - 1), min(max(left, right - 1), n - 1)
                    assert table.least(np.array([first]), np.array([last]))[0] == gaps[first : last + 1].min()


def plain_whitening(vectors: np.ndarray, k: int = 16):
    x = np.floor(64 * vectors.astype(np.float64)).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    covariance = centred.T @ centred / n
    values, q = np.linalg.eigh(covariance)
    values, q = values[::-1][:k], q[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ q / np.sqrt(values), values / np.trace(covariance)


def vectors(n: int, dim: int, seed: int = 5) -> np.ndarray:
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(n, dim)) * np.geomspace(20, 0.5, dim)) @ np.linalg.qr(draw.normal(size=(dim, dim)))[0]


def by_row(frame) -> dict:
    out = collections.defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (str(r["vec_id"]), r["component"])):
        out[r["vec_id"]].append(r)
    return out


@pytest.mark.parametrize("dim", [3, 24])
def test_whitening_equals_plain_eigenvectors(spark, dim):
    values = vectors(400, dim).astype(np.float32)
    values[250:] = values[0]  # a third and more are copies
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(values)]
    bad = [(900, None, 0), (901, [], 0), (902, [None] * dim, 0), (903, [float("nan")] * dim, 0), (904, [float("inf")] * dim, 0)]
    bad.append((905, [1e300, *[0.0] * (dim - 1)], 0))
    frame = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<double>, x int").repartition(6)
    got = by_row(whiten.whitened(frame))
    n, deviations, want, shares = plain_whitening(values)
    assert sorted(got) == list(range(400)) and n == 250
    k = min(16, dim)
    table = np.array([[r["whitened"] for r in got[i]] for i in range(400)])
    assert table.shape == (400, k)
    signs = np.sign((table * want).sum(axis=0))
    assert np.abs(table - want * signs).max() < 1e-8
    for i in (0, 100, 399):
        assert {(r["n"], r["deviation"]) for r in got[i]} == {(n, int(deviations[i]))}
        assert np.allclose([r["explained"] for r in got[i]], shares, rtol=1e-9)
        assert got[i][0]["identity_error"] < 1e-10


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whiten.whitened(spark.createDataFrame([], schema)).collect() == []
    # one different vector has no variance; a dimension without variance is no component
    assert whiten.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    flat = whiten.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (None, [3.0, 2.0]), (3, [3.0, 2.0])], schema)).collect()
    assert {(r["vec_id"], r["component"], r["n"], abs(r["whitened"]), r["explained"]) for r in flat} == {
        (1, 1, 2, 1.0, 1.0),
        (None, 1, 2, 1.0, 1.0),
        (3, 1, 2, 1.0, 1.0),
    }
    # lengths are whitened apart, whether they are fitted at once or one by one
    mixed = [(i, [float(i % 5), float(i % 3)]) for i in range(15)] + [(100 + i, [float(i)]) for i in range(4)]
    frame = spark.createDataFrame(mixed, schema)
    for most in (1 << 28, 1):
        got = by_row(whiten.whitened(frame, whiten.WhitenParams(model_bytes=most)))
        assert {len(got[i]) for i in range(15)} == {2} and {len(got[100 + i]) for i in range(4)} == {1}
        assert got[0][0]["n"] == 15 and got[100][0]["n"] == 4


def test_whitening_of_huge_values_stays_exact(spark):
    rows = [(i, [float(i) * 2**40, float((i * 7) % 11) * 2**33]) for i in range(12)]
    got = by_row(whiten.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    n, _, want, shares = plain_whitening(np.array([v for _, v in rows]))
    table = np.array([[r["whitened"] for r in got[i]] for i in range(12)])
    assert np.abs(np.abs(table) - np.abs(want)).max() < 1e-6
    assert got[0][0]["deviation"] is None and got[0][0]["n"] == n
    assert np.allclose([r["explained"] for r in got[0]], shares, rtol=1e-6)


def test_cholesky_and_jacobi_keep_small_eigenvalues():
    draw = np.random.default_rng(9)
    for d in (1, 2, 5, 33):
        q = np.linalg.qr(draw.normal(size=(d, d)))[0]
        want = np.geomspace(1e6, 1e-3, d)
        v = (q * want) @ q.T
        values, unit = whiten.components((v + v.T) / 2, whiten.WhitenParams(components=d))
        assert np.allclose(values, want, rtol=1e-5)
        assert np.allclose(unit.T @ unit, np.eye(d), atol=1e-9)
    order, factor = whiten.pivoted_cholesky(np.ones((4, 4)))
    assert factor.shape == (4, 1) and np.allclose(factor @ factor.T, 1)
