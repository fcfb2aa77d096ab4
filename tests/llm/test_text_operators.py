"""Tokens, packing, archives, pages and language-model scores against plain versions."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from courierlens.llm import bpe, html, packing, ppm, warc
from courierlens.llm.common import new_path
from courierlens.llm.queries import pack_params
from courierlens.llm.wordcoder import to_bytes

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PACK = packing.PackParams(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
ODD = [
    None,
    "",
    " ",
    "  a  b\n c \n\n d ",
    "x <|endoftext|> y",
    "it's we'll 'd\t\tz  ",
    "a. b.. c, d,, é! ? x?! .",
    "日本 語 テ　スト 🎉 🎉 ​ x",
    "a\x1cb \x1d c\x1f d\x85 e",
    "a" * 5000,
    "ab " * 30_000,
    "same text",
    "same text",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, text, "clash", 1) for i, text in enumerate(ODD)] + [(None, "no id", "clash", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, place long")


def random_texts(n: int) -> list[str]:
    draw = random.Random(5)
    letters = "ab cdeé\n\t '’sltré日🎉12.!?$%  ñ"
    return ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize(("many", "most", "chars"), [(24, 400_000, 4_000_000), (0, 50, 200), (10**9, 400_000, 4_000_000)])
def test_merge_replay_gives_the_ids_of_the_library(many, most, chars):
    ranks = bpe.read_ranks(MULTI)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = bpe.MatchCoder(ranks, public_tokenizers.PATTERN, most, chars)
    coder.replay.many = many
    texts = [t or "" for t in ODD] + random_texts(1500) + ["a" * n for n in range(60)] + ["ab" * n + "a" for n in range(40)]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


def test_merge_replay_when_a_merge_makes_an_earlier_one_possible():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"ab": 500, b"bcab": 301, b"bc": 600}
    words = [b"abcabc", b"ababcab", b"bcab", b"", b"abab"] * 9
    for many in (0, 24, 10**9):
        replay = bpe.MergeReplay(ranks, many)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in replay.encode(words)] == [replay.encode_alone(w) for w in words]
    for word, ids in zip(words, replay.encode(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == replay.encode_alone(word)


def test_byte_bpe_round_trip(odd):
    rows = bpe.encoded_and_decoded(odd, MULTI, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ODD) + 1
    for row in rows:
        text = "no id" if row["doc_id"] is None else ODD[row["doc_id"]] or ""
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encoded_and_decoded(odd.limit(0), MULTI, public_tokenizers.PATTERN).collect() == []


def test_packing_ids_are_those_of_the_tokenizer_file():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    texts = [t or "" for t in ODD] + random_texts(800)
    coder = packing.file_coder(PACK.ranks, PACK.pattern)
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert ids == to_bytes(tokenizer.encode(text, add_special_tokens=False).ids)


def test_packing_finds_the_added_tokens_of_the_tokenizer_file(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, f"{mark}{mark}x", f"one,{mark}\n\n two {mark}", f" {mark} {mark} ", "<|endoftext|", *ODD[1:], *random_texts(300)]
    texts += [mark.join(random_texts(4)), " ".join([mark] * 1500)]
    params = pack_params()
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    coder = packing.file_coder(params.ranks, params.pattern, params.added)
    assert coder.encode([None, *texts]) == [b"", *map(to_bytes, want)]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), params).collect()
    for row in rows:
        ids = [*want[row["doc_id"]], 2][row["start"] : row["start"] + row["length"]]
        assert (len(ids), zlib.crc32(to_bytes(ids))) == (row["length"], row["ids_crc32"])
    assert sum(r["length"] for r in rows) == sum(map(len, want)) + len(texts)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    draw = np.random.default_rng(seed)
    capacity = int(draw.integers(5, 60))
    lengths = draw.integers(1, capacity + 1, int(draw.integers(0, 400)))
    counts = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True), strict=True)}
    fillings = packing.plan(counts, capacity)
    placed = collections.Counter()
    for filling in fillings:
        assert filling.used <= capacity
        for length, count in filling.runs:
            placed[length] += count * filling.times
    assert placed == counts
    # never more sequences than first fit over decreasing lengths needs
    bins: list[int] = []
    for length in sorted(lengths.tolist(), reverse=True):
        at = next((i for i, used in enumerate(bins) if used + length <= capacity), None)
        if at is None:
            bins.append(length)
        else:
            bins[at] += length
    assert sum(f.times for f in fillings) <= max(len(bins) + 1, math.ceil(len(bins) * 1.03))


def test_packing_covers_every_token(odd):
    rows = packing.pack(odd, PACK).collect()
    coder = packing.file_coder(PACK.ranks, PACK.pattern)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for row in rows:
        by_doc[row["doc_id"]].append(row)
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
    for doc_id in [*range(len(ODD)), None]:
        ids = coder.encode(["no id" if doc_id is None else ODD[doc_id]])[0] + to_bytes([2])
        at = 0
        for piece, row in enumerate(sorted(by_doc[doc_id], key=lambda r: r["piece"])):
            assert (row["piece"], row["start"]) == (piece, at)
            assert piece == 0 or row["length"] == 1024
            assert row["ids_crc32"] == zlib.crc32(ids[4 * at : 4 * (at + row["length"])])
            at += row["length"]
        assert at == len(ids) // 4
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(odd.limit(0), PACK).collect() == []


PAGES = [
    (3, "http://a.example/1", "<p>one</p>"),
    (1, None, "<p>one</p>"),
    (2, "http://a.example/\r\nx", "zwei ü"),
    (4, "u", None),
    (5, "u", ""),
    (6, "u", "long " * 200_000),
    (7, "u", "<p>one</p>"),
    (None, "u", "zwei ü"),
    (-1, "u", "minus one"),
]


def test_archives_give_back_every_page(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string")
    rows = {r["page_id"]: r for r in warc.archived(pages.repartition(3)).collect()}
    first = {}
    for page_id, _, source in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        first.setdefault(source or "", page_id)
    for page_id, _, source in PAGES:
        payload = (source or "").encode()
        refers_to = first[source or ""] if page_id is not None and first[source or ""] != page_id else None
        row = rows[page_id]
        assert row["payload_bytes"] == len(payload)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (row["record_type"], row["refers_to"]) == ("revisit" if refers_to else "response", refers_to)
    assert warc.archived(pages.limit(0)).collect() == []
    several = pages.unionByName(pages.filter("page_id is null")).unionByName(pages.filter("page_id is null"))
    index = warc.write_archives(several, new_path(spark, "warc-test"))
    assert index.select("record_id").distinct().count() == several.count()
    longer = {r["page_id"]: r["record_type"] for r in warc.archived(pages, least_bytes=11).collect()}
    assert set(longer.values()) == {"response"}


def test_bundle_is_seekable(tmp_path):
    import pyarrow as pa

    path = tmp_path / "b.zst"
    with open(path, "wb") as out:
        writer = warc.BundleWriter(out, 100, 3)
        records = [warc.make_record(i, "u", b"x" * i, "D", None) for i in range(50)]
        places = [writer.add(r) for r in records]
        writer.close()
    assert len(writer.sizes) > 10
    magic, size = struct.unpack("<II", path.read_bytes()[-(len(writer.sizes) * 8 + 17) :][:8])
    assert (magic, size) == (warc.SKIPPABLE_MAGIC, len(writer.sizes) * 8 + 9)
    reader = warc.BundleReader(pa.OSFile(str(path)))
    for i in random.Random(1).sample(range(50), 50):
        assert reader.record(*places[i], len(records[i])) == records[i]


def test_main_text_of_one_page():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
    <div class="cookie-notice">We use cookies</div><nav>menu</nav><div id="main"><h2>Head &amp; more</h2>
    <p>One<b>two</b> three<br>four&nbsp;five<p>Next <script>if (a<b) "</p>"</script>&lt;tag&gt;<ul><li>a<li>b</ul>
    <div class=sidebar>side</div><!-- c --><form><input value=1>f</form><section class="comments"><p>first!</p></section>
    </div><footer>foot</footer></body></html>"""
    assert html.main_text(page) == "Head & more Onetwo three four five Next <tag> a b"
    assert html.main_text(None) == html.main_text("") == html.main_text("<script>x") == ""
    assert html.main_text("<p>a</b>c</div>d") == "acd"


@pytest.mark.parametrize(
    "box",
    [
        '<article class="comment"><p>{0}</p></article>',
        '<section id="comments"><h3>Replies</h3><p>{0}</p></section>',
        '<ol class="commentlist"><li><p>{0}</p></li></ol>',
        '<div class="user-comment"><p>{0}</p></div>',
        '<div class="comment-thread"><p>{0}</p></div>',
        '<div class="usercomments"><p>{0}</p></div>',
        '<div id="commentList"><article><p>{0}</p></article></div>',
        '<div class="ad-slot"><p>{0}</p></div>',
        '<p class="ad">{0}</p>',
        '<div class="post-share-buttons"><a href="/s">share this</a> <a href="/t">tell a friend</a></div>',
        '<section id="related-posts"><ul><li><a href="/a">one more story</a></li><li><a href="/b">and one</a></li></ul></section>',
        '<table id="sidebar"><tr><td>{0}</td></tr></table>',
        '<aside class="sidebar"><p>{0}</p></aside>',
    ],
)
def test_comments_adverts_and_sidebars_go_whatever_holds_them(box):
    said = "A whole paragraph that a reader or an advertiser wrote, long enough to be taken for prose by its length alone."
    inside = f"<html><body><article><p>Main text.</p>{box.format(said)}<p>More.</p></article></body></html>"
    outside = f"<html><body><article><p>Main text.</p><p>More.</p></article>{box.format(said)}</body></html>"
    assert html.main_text(inside) == html.main_text(outside) == "Main text. More."


def test_words_beside_others_are_no_kind():
    kept = """<article><p class="share-price">Price</p><div class="commentary"><p>A commentary</p></div><h2 class="comments">On comments</h2>
    <p id="comment">Anchor</p><div class="adverse"><p>Adverse</p></div><section id="discussion"><p>Discussion</p></section>
    <section id="legal"><p>Law</p></section><div class="comment-on-law"><p>Opinion</p></div></article>"""
    assert html.main_text(kept) == "Price A commentary On comments Anchor Adverse Discussion Law Opinion"


def test_names_do_not_drop_prose():
    article = """<article><h2 id="Legal_status">Legal</h2><p class="share-price">Price</p><section id="discussion"><h2>Discussion</h2>
    <p>Found.</p></section><table id="search"><tr><td>cell</td></tr></table><div class="discussion"><p>More.</p></div>
    <div class="related-work">Work</div><blockquote class="notice">Quote</blockquote>{}</article>"""
    kept = "Legal Price Discussion Found. cell More. Work Quote"
    boxes = """<div class="ad">x</div><div class="cookie-notice">x</div><div class="share"><a href="/">x</a></div><ul class="related links">
    <li><a href="/">x</a></ul><section class="comments"><p>x</p></section><div class="social">x</div><div id="sidebar"><p>x</p></div>"""
    assert html.main_text(article.format(boxes)) == kept
    outside = "<div><h2 id='Related_work'>Related</h2><p class='share-price'>Price</p><section id='discussion'>Text</section>"
    assert html.main_text(outside + "<p class='copyright'>c</p><div class='site-nav'>n</div></div>") == "Related Price Text"


def test_templates_go_and_articles_stay(spark):
    rows = [
        (
            i,
            f"http://User@H.example.com:80/{i}",
            f"<body><div class='x1'>Menu <i>{'a' if i % 2 else 'b'}</i></div><div><p>Own text {i}.</p></div><div>Promo</div></body>",
            0,
        )
        for i in range(40)
    ]
    copies = [(100 + i, f"http://c.example/{i}", f"<body><nav>{i}</nav><article><p>Copied words</p></article></body>", 0) for i in range(40)]
    odd = [(200, None, None, 0), (201, "nohost", "", 0), (202, "http://h.example.com/q", "<p>alone</p>", 0), (None, None, "<p>x", 0)]
    pages = spark.createDataFrame(rows + copies + odd, "page_id long, url string, html string, n_chars int")
    got = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    assert all(got[i] == f"Own text {i}." for i in range(40))
    assert all(got[100 + i] == "Copied words" for i in range(40))
    assert (got[200], got[201], got[202], got[None]) == ("", "", "alone", "x")
    assert html.extract(pages.limit(0)).collect() == []


def test_copies_without_an_article_stay(spark):
    story = "A long story told in several places. " * 8
    page = "<body><div>Crumb {0} of the site</div><div class='content'><p>{1}</p></div><div>Views {0}</div></body>"
    rows = [(i, f"http://h.example/{i}", page.format(i, story if i < 5 else f"{story} Its number is {i}.")) for i in range(100)]
    about = "<div class='info'>" + "About this company and what it stands for. " * 5 + "</div>"
    rows += [(100 + i, f"http://a.example/{i}", f"<body><div><p>{story * 2} {i}</p></div>{about}<b>{i}</b></body>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    assert all(story.strip() in got[i] for i in range(100))
    assert all(story.strip() in got[100 + i] and "About" not in got[100 + i] for i in range(40))


def test_templates_in_elements_of_any_tag_go(spark):
    menu = "<ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul>"
    custom = f"<body><site-menu>{menu}</site-menu><div><p>Own <b>bold</b> text {{0}}.</p></div></body>"
    cells = f"<body><table><tr><td>{menu}</td></tr><tr><td><p>Own <b>bold</b> text {{0}}.</p></td></tr></table></body>"
    rows = [(i + 100 * n, f"http://h{n}.example/{i}", p.format(i)) for n, p in enumerate((custom, cells)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for row in html.extract(pages).collect():
        assert row["text"] == f"Own bold text {row['page_id'] % 100}."


def plain_ppm(texts: dict, params: ppm.PpmParams) -> dict:
    """Scores by walking down dictionaries of contexts, byte by byte."""
    k_most = params.order
    trie = [collections.defaultdict(collections.Counter) for _ in range(k_most + 1)]
    words = collections.Counter()

    def tokens(text):
        return (text or "").encode().lower().split()

    def stream(text):
        return b"\t" * k_most + b" ".join(tokens(text)) + b"\n"

    held = {i: zlib.crc32(str(i).encode()) % params.folds == params.held_out for i in texts}
    for i, text in texts.items():
        if not held[i]:
            words.update([*tokens(text), b""])
            s = stream(text)
            for at in range(k_most, len(s)):
                for k in range(k_most + 1):
                    trie[k][s[at - k : at]][s[at]] += 1

    def cost(s, at):
        total, excluded = 0.0, set()
        for k in range(k_most, -1, -1):
            seen = {x: n for x, n in trie[k].get(s[at - k : at], {}).items() if x not in excluded}
            events = sum(seen.values()) + len(seen)
            if s[at] in seen:
                return total + math.log10(seen[s[at]] / events)
            if seen:
                total += math.log10(len(seen) / events)
            excluded |= set(seen)
        return total - math.log10(256 - len(excluded))

    n, v = sum(words.values()), len(words)
    result = {}
    for i, text in texts.items():
        s, found = stream(text), [*tokens(text), b""]
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in found)
        score = sum(cost(s, at) for at in range(k_most, len(s)))
        result[i] = (held[i], len(found), sum(words[w] > 0 for w in found), n, base, score)
    return result


def test_scores_equal_a_walk_down_the_trie(spark):
    draw = random.Random(3)
    texts = {i: " ".join(draw.choice(["the", "then", "Ñandú", "THE", "zebra", str(i)]) for _ in range(draw.randint(0, 30))) for i in range(60)}
    texts |= {60: None, 61: "", 62: " \n\t", 63: "q" * 20_000, 64: texts[0], 65: "日本\x0blow"}
    frame = spark.createDataFrame([(i, t, 1.0) for i, t in texts.items()], "doc_id long, text string, score double")
    params = ppm.PpmParams(order=3)
    want = plain_ppm(texts, params)
    rows = ppm.scores(frame, params).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = want[row["doc_id"]]
        assert tuple(row)[1:5] == expected[:4]
        assert row["base_score"] == pytest.approx(expected[4])
        assert row["score"] == pytest.approx(expected[5])
    assert ppm.scores(frame.limit(0), params).collect() == []
    # the same whatever the splits and blocks, also where the splits differ between the passes
    small = ppm.PpmParams(order=3, block_rows=3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        again = ppm.scores(frame.repartition(5), small)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        key = lambda r: (str(r["doc_id"]), r["n_tokens"], round(r["score"], 6), round(r["base_score"], 6), r["n_known"])
        assert sorted(map(key, again.collect())) == sorted(map(key, rows))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(ValueError, match="does not know"):
        ppm.looked_up(np.array([1, 3, 5]), np.zeros(3), np.array([3, 4]))
    held = frame.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
    assert {r["train_tokens"] for r in ppm.scores(held, params).collect()} == {0}
