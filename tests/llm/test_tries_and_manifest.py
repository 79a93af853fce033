"""Operators 11 to 13 against brute force and the public library, with odd rows among ordinary ones."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deliverylens.llm import burst_trie, merkle, trie_bpe
from deliverylens.llm.queries import QUERIES, checksum
from deliverylens.llm.url_filter import lower_ascii

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def brute_trie(rows):
    def digest(role, text):
        return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()

    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))
    for turns in convs.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, digest(t[1], t[2])))
    seqs, nodes, kids = {}, {}, {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(t[1:] for t in convs.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
        for d in range(len(seqs[c]) + 1):
            nodes.setdefault(seqs[c][:d], []).append(c)
    for node in nodes:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(nodes, key=len, reverse=True):
        own = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids.get(node, [])) or 1
        saved[node] = sum(saved[k] for k in kids.get(node, [])) + (len(nodes[node]) - 1) * own
    out = []
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(seqs[c]) == len(node))
        parent = min(nodes[node[:-1]]) if node else None
        out.append((min(members), len(node), parent, len(members), len(kids.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return ordered(out)


TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def turns():
    draw, rows = random.Random(3), []
    for c in range(-200, 600):
        for t in range(draw.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, draw.choice([t, t, t, None, 1]), draw.choice(["user", "bot", None, ""]), draw.choice(["x", "hello there", " ", "é \n z", None, "w " * 40])))
    # A third of all conversations alike, one very long one and one very long text.
    rows += [(c, t, "user", "the same") for c in range(1000, 1400) for t in range(3)]
    return rows + [(7, t, "user", str(t % 3)) for t in range(2000)] + [(8, 0, "user", "long " * 50000)] + [(None, 1, "user", "x")] * 3 + rows[:10]


@pytest.mark.parametrize("most", [2, 40, 512])
def test_trie_equals_brute_force(spark, turns, monkeypatch, most):
    monkeypatch.setattr(burst_trie, "BURST", most)
    monkeypatch.setattr(burst_trie, "PIECE", 7)
    table = spark.createDataFrame(turns, TURNS).repartition(3).withColumns({c: F.lit(5) for c in ("seq", "base", "own", "a.b")})
    assert ordered(map(tuple, burst_trie.prefix_trie(table).collect())) == brute_trie(turns)


def test_trie_query_and_empty_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert ordered(map(tuple, QUERIES["op11_conversation_trie"](spark, SF_DIR).collect())) == brute_trie(rows)
    assert burst_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    turnless = [(1, None, None, None)] * (zlib.crc32(b"1") % 4)
    assert ordered(map(tuple, burst_trie.prefix_trie(spark.createDataFrame(turnless, TURNS)).collect())) == brute_trie(turnless)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row, lower=False):
    out = ""
    for i, value in enumerate(row):
        text = None if value is None else str(value)
        if lower and i == 4:
            text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        out += "-" if text is None else f"{len(text.encode())}:{text}"
    return digest(out)


def climb(level, at, path):
    while len(level) > 1:
        low = at - at % 8
        path.append((at % 8, level[low : low + 8]))
        at //= 8
        level = [digest("".join(level[k : k + 8])) for k in range(0, len(level), 8)]
    return level[0]


def brute_manifest(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    leaves = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (2**63 - 1 if r[0] is None else r[0], brute_leaf(r)))
        leaves[lang] = [brute_leaf(r) for r in langs[lang]]
    tops, out = [climb(leaves[lang], 0, []) for lang in order], []
    for k, lang in enumerate(order):
        for i, r in enumerate(langs[lang]):
            path = []
            climb(leaves[lang], i, path)
            root = climb(tops, k, path)
            siblings = "".join(d for at, run in path for j, d in enumerate(run) if j != at)
            changed = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            now = brute_leaf(r, changed)
            for at, run in path:
                now = digest("".join([*run[:at], now, *run[at + 1 :]]))
            out.append((r[0], leaves[lang][i], tops[k], root, digest(siblings), now, now == root))
    return ordered(out)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def made(docs):
    changed = (checksum(3) == 0) & F.col("text").isNotNull()
    return merkle.manifest(docs, lower_ascii(F.col("text")), changed).drop("g")


def test_manifest_equals_brute_force(spark):
    rows = [(i * 7 - 100, "s", "en", i, f"Text {i} A") for i in range(4700)]  # ten blocks, the last one short
    rows += [(i, None, None, None, None) for i in range(513)]  # a last block of one leaf
    rows += [(i, "s", "es", 1, "É") for i in range(512)]
    # A hot id with three texts, repeated rows, null ids, the largest id and a language that looks like a key.
    rows += [(5, "s", "de", 1, f"T{i % 3}") for i in range(900)] + [(None, "s", "de", 1, "X")] * 70 + [(None, "s", "fr", 1, "X"), (2**63 - 1, "s", "de", 1, "Y"), (9, "a", "=x", 1, "A" * 100000), (10, "a", "", 0, "")]
    rows += [(i, "s", f"l{i}", i, "é") for i in range(40)]
    rows += [(-(2**63), "s", "en", 0, "least"), (2**40, "s", "en", 0, "far")]
    docs = spark.createDataFrame(rows, DOCS).repartition(5).withColumns({c: F.lit("7") for c in ("g", "key", "pos", "word", "a.b")})
    assert ordered(map(tuple, made(docs).collect())) == brute_manifest(rows)


def test_manifest_query_and_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    got = ordered(map(tuple, QUERIES["op12_merkle_manifest"](spark, SF_DIR).collect()))
    assert got == brute_manifest([tuple(r) for r in docs.collect()])
    assert {r[6] for r in got} == {True, False}
    assert made(docs.limit(0)).collect() == []


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(WORD_FILE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def random_texts():
    draw = random.Random(1)
    alphabets = ["ab", "aab", "abcdefghij ", "theinrs", "haha", "😂😍🇺🇸", "=-_.", "oO0 '", "İıΣσς ß", "日本語の ", " \x85\xa0 x \x1c", "<|endoftext|> a", "éȩ̀́ aẹ", "क्षि", "'stvrelmd "]
    out = ["".join(draw.choices(a, k=draw.randint(0, 60))) for a in alphabets for _ in range(300)]
    out += ["".join(chr(draw.choice([draw.randrange(0x250), draw.randrange(0xE000, 0x20000), draw.randrange(0xD800)])) for _ in range(20)) for _ in range(2000)]
    out += [f"a{chr(c)}b {chr(c)}" for c in [*range(0xD800), *range(0xE000, 0x11000)]]
    return out + ["x<|endoftext|>y", "<|startoftext|><|endoftext|>", "<|endoftext|", "<|ENDOFTEXT|>", "a" * 30000, "ab" * 20000, "." * 5000, "", "it's we'll I'D"]


def test_word_bpe_equals_the_library(library):
    encoder, texts = trie_bpe.ChunkEncoder(WORD_FILE), random_texts()
    got = encoder.encode(texts)
    for text, ids, expected in zip(texts, got, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == expected.ids, text
        assert encoder.decode(ids) == library.decode(expected.ids, skip_special_tokens=False), text


def test_word_bpe_forgets_without_harm(library, monkeypatch):
    monkeypatch.setattr(trie_bpe, "KNOWN_CHUNKS", 50)
    encoder = trie_bpe.ChunkEncoder(WORD_FILE)
    for k in range(5):
        texts = [f"word{i % 7} other{i} it's {'z' * 1500}" for i in range(k, k + 60)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_trie_shares_prefixes():
    merges, root = trie_bpe.Merges(WORD_FILE), trie_bpe.Node(False)
    words = [b"there", b"them", b"the", b"thesis", b"a", b"the"]
    for word in words:
        trie_bpe.insert(root, word)
    assert set(root.edges) == {ord("t"), ord("a")} and root.edges[ord("t")][0] == b"the"
    assert trie_bpe.encode_words(words, merges).keys() == set(words)


def test_word_bpe_table(spark, library):
    rows = [(i, t, 3) for i, t in enumerate([None, "", "Hello  WORLD's", "é" * 40, "x" * 100000, "same", "same"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `ids.decoded` int").withColumn("rest", F.lit(1)).withColumn("ids", F.lit(2))
    got = {r.rest.doc_id: r for r in trie_bpe.encode_decode(docs, WORD_FILE).collect()}
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].decoded == library.decode(ids, skip_special_tokens=False)
    assert trie_bpe.encode_decode(docs.limit(0), WORD_FILE).count() == 0
    one = QUERIES["op13_word_bpe"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in one:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))
