"""Operator 13: BPE over words with an end mark, encoded in depth-first order of a prefix trie.

Texts are cut at ASCII white space into chunks, which the normaliser and the
pattern of the tokenizer treat independently; a chunk that returns within a task
is looked up. The words of new chunks go into a path-compressed trie. Its
depth-first traversal carries one state a depth: the last token of the encoding
of that prefix, from which the tokens before it follow by going back its length.
So words with a common prefix compute its states once, and a word of n bytes
takes about n steps, however long it is.

The last token of a prefix is the one token that ends there and fits the last
token of what is left. Two tokens fit if no merge across their border comes
before the merges that built them (see ``Merges.clash``); a sequence of tokens is
what the merges make of a word exactly if all its neighbours fit. The last byte
of a word is a symbol of its own (the byte with the end mark), so it gets its
state from the prefix before it and never from a longer word.

Defined cases: null and empty texts have no ids and decode to the empty string;
strings of added tokens within a text become their ids; equal rows are encoded
alike. Columns other than the text are carried in ``rest`` under any name.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType
from tokenizers import Tokenizer

from deliverylens.llm.common import ship, small_batches

ship(__name__)

KNOWN_CHUNKS = 300_000  # chunks a task remembers before it starts anew
LONG_CHUNK = 1000  # bytes from which a chunk is not remembered
PART_ROWS, PART_CHARS = 500, 2 << 20
NEVER = 1 << 40  # later than any merge

#: Characters that composition leaves as they are and that no table of classes has moved since; the dotted I becomes two characters.
PLAIN = regex.compile(r"[\x00-įı-ɏ]*")
PLAIN_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+")


def byte_alphabet() -> dict[str, int]:
    """The printable character by which byte-level vocabularies write each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Tokens and merges of a vocabulary file; a token with the end mark is known by its bytes in ``final``."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, added = file["model"], file["added_tokens"]
        mark = model["end_of_word_suffix"]
        if not mark or model["continuing_subword_prefix"] or model["ignore_merges"] or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in added):
            raise ValueError(f"{path}: not a vocabulary of words with an end mark and plain added tokens")
        byte_of, vocab = byte_alphabet(), model["vocab"]
        self.added = {t["content"]: t["id"] for t in added}
        self.names = {i: token for token, i in vocab.items()} | {i: token for token, i in self.added.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = vocab[left], vocab[right]
            self.rank[pair], self.parts[vocab[left + right]] = rank, pair
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token, i in vocab.items():
            last = token.endswith(mark)
            own = bytes(byte_of[c] for c in (token[: -len(mark)] if last else token))
            if len(own) == 1 or i in self.parts:
                (self.final if last else self.inner)[own] = i
        # Ends of tokens that are none themselves: where a longer one may still follow.
        for table in (self.inner, self.final):
            for own in list(table):
                for k in range(1, len(own)):
                    table.setdefault(own[k:], -1)
        self.sound: dict[int, bool] = {}
        self.fit: dict[int, bool] = {}

    def clash(self, left: int, right: int, until: int = NEVER) -> bool:
        """Whether a merge across the border of two tokens comes before ``until`` and before those that built them.

        The border lies between the right edge of the left token, which is one of
        its successive last parts at each time, and the left edge of the right one.
        Of two merges of equal rank the left one is first.
        """
        rank, parts = self.rank, self.parts
        x, x_ends = left, until
        while True:
            y, y_ends = right, until
            while True:
                between = rank.get((x, y), NEVER)
                if between < x_ends and between <= y_ends:
                    return True
                if y not in parts:
                    break
                y_ends = rank[parts[y]]
                y = parts[y][0]
            if x not in parts:
                return False
            x_ends = rank[parts[x]]
            x = parts[x][1]

    def is_sound(self, token: int) -> bool:
        """Whether the merges make this token of its own bytes."""
        known = self.sound.get(token)
        if known is None:
            pair = self.parts.get(token)
            known = pair is None or (self.is_sound(pair[0]) and self.is_sound(pair[1]) and not self.clash(*pair, until=self.rank[pair]))
            self.sound[token] = known
        return known

    def follows(self, left: int, right: int) -> bool:
        """Whether the right token may come after the left one in an encoding; remembered by both numbers in one."""
        if len(self.fit) > 2_000_000:
            self.fit.clear()
        known = self.fit[left << 32 | right] = self.is_sound(right) and not self.clash(left, right)
        return known

    def last_token(self, table: dict[bytes, int], path: bytes, end: int, states: list[int]) -> tuple[int, int]:
        """The last token of ``path[:end]`` and its length, from the states of the shorter prefixes."""
        known = self.fit.get
        for size in range(1, end + 1):
            token = table.get(path[end - size : end])
            if token is None:
                break
            if token >= 0:
                if size == end:
                    right = self.is_sound(token)
                else:
                    right = known(states[end - size] << 32 | token)
                    if right is None:
                        right = self.follows(states[end - size], token)
                if right:
                    return token, size
        raise ValueError(f"no token ends at {end} of {path[max(0, end - 40) : end]!r}")


class Node:
    """A branching of the trie, or a word that is the beginning of others; ``edges`` by first byte: label and what is below, None under a leaf."""

    __slots__ = ("edges", "ends")

    def __init__(self, ends: bool) -> None:
        self.edges: dict[int, tuple[bytes, Node | None]] = {}
        self.ends = ends


def insert(root: Node, word: bytes) -> None:
    """Put a word, not empty, into the trie, whose edges hold one or more bytes."""
    node, at, n = root, 0, len(word)
    while at < n:
        edge = node.edges.get(word[at])
        if edge is None:
            node.edges[word[at]] = (word[at:], None)
            return
        label, below = edge
        if word.startswith(label, at):
            if below is None:
                if at + len(label) == n:
                    return
                below = Node(True)
                node.edges[word[at]] = (label, below)
            node, at = below, at + len(label)
            continue
        k = 1
        while at + k < n and label[k] == word[at + k]:
            k += 1
        middle = Node(at + k == n)
        middle.edges[label[k]] = (label[k:], below)
        node.edges[word[at]] = (label[:k], middle)
        node, at = middle, at + k
    node.ends = True


def encode_words(words: Iterable[bytes], merges: Merges) -> dict[bytes, bytes]:
    """Ids of distinct words, little-endian in four bytes each."""
    root = Node(False)
    for word in words:
        insert(root, word)
    out: dict[bytes, bytes] = {}
    inner, final, last_token = merges.inner, merges.final, merges.last_token
    last, size = [-1], [0]  # of the prefix of each length on the way from the root
    stack = [(label, node, b"") for label, node in root.edges.values()]
    while stack:
        label, node, above = stack.pop()
        path, low = above + label, len(above) + 1
        del last[low:], size[low:]
        for end in range(low, len(path) + (node is not None)):
            token, n = last_token(inner, path, end, last)
            last.append(token)
            size.append(n)
        if node is None or node.ends:
            token, n = last_token(final, path, len(path), last)
            ids, at = [token], len(path) - n
            while at:
                ids.append(last[at])
                at -= size[at]
            ids.reverse()
            out[path] = pack(ids)
        if node is not None:
            stack.extend([(label, below, path) for label, below in node.edges.values()])
    return out


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class ChunkEncoder:
    """Ids of chunks of text without ASCII white space."""

    def __init__(self, path: str) -> None:
        self.merges = Merges(path)
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        # The normaliser and the splitter are the library's where tables of characters matter; encoding is not.
        self.alphabet = str.maketrans({c: chr(b) for c, b in byte_alphabet().items()})
        added = sorted(self.merges.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")" if added else "(?!)")
        self.known: dict[bytes, bytes] = {}  # of chunks
        self.words: dict[bytes, bytes] = {}

    def split(self, text: str) -> list[bytes]:
        """The words of a chunk as bytes."""
        if PLAIN.fullmatch(text):
            return [w.encode() for w in PLAIN_WORDS.findall(text.lower())]
        found = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [w.translate(self.alphabet).encode("latin-1") for w, _ in found]

    def learn(self, chunks: set[bytes]) -> None:
        """Encode new chunks: their new words share one trie."""
        if len(self.words) >= KNOWN_CHUNKS:
            self.words.clear()
        cut: dict[bytes, list[bytes]] = {}
        marked: dict[bytes, list] = {}
        for chunk in chunks:
            if chunk.isalpha():  # ASCII letters
                cut[chunk] = [chunk.lower()]
            elif self.added.search(text := chunk.decode()):
                marked[chunk] = [pack([self.merges.added[p]]) if k % 2 else self.split(p) for k, p in enumerate(self.added.split(text))]
            else:
                cut[chunk] = self.split(text)
        own = [p for parts in marked.values() for p in parts[::2]]
        words = set(chain(chain.from_iterable(cut.values()), chain.from_iterable(own)))
        ids = self.words
        ids.update(encode_words(words.difference(ids), self.merges))
        known = ids.__getitem__
        for chunk, parts in cut.items():
            self.known[chunk] = b"".join(map(known, parts))
        for chunk, parts in marked.items():
            self.known[chunk] = b"".join(p if k % 2 else b"".join(map(known, p)) for k, p in enumerate(parts))
        for word in words:
            if len(word) > LONG_CHUNK:
                del ids[word]

    def encode(self, texts: list[str]) -> list[bytes]:
        found = [text.encode().split() for text in texts]
        if len(self.known) >= KNOWN_CHUNKS:
            self.known.clear()
        fresh = set(chain.from_iterable(found)).difference(self.known)
        self.learn(fresh)
        out = [b"".join(map(self.known.__getitem__, chunks)) for chunks in found]
        for chunk in fresh:
            if len(chunk) > LONG_CHUNK:
                del self.known[chunk]
        return out

    def decode(self, ids: bytes) -> str:
        """The tokens of packed ids, with a space between them, as the file names no decoder."""
        return " ".join(map(self.merges.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def stretches(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts that share one trie: at most PART_ROWS, and PART_CHARS unless one text is longer."""
    low = total = 0
    for i, text in enumerate(texts):
        if i > low and (i - low >= PART_ROWS or total + len(text) > PART_CHARS):
            yield low, i
            low, total = i, 0
        total += len(text)
    if low < len(texts):
        yield low, len(texts)


def tokenizer(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for low, high in stretches(texts):
                ids = encoder.encode(texts[low:high])
                yield pa.record_batch({"rest": batch.column("rest").slice(low, high - low), "ids": pa.array(ids, pa.binary()), "decoded": pa.array(map(encoder.decode, ids), pa.string())})

    return run


def encode_decode(docs: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """All other columns in the struct ``rest``, the ids packed as little-endian unsigned 32-bit integers, and the text they decode to.

    ``path`` names the vocabulary file, which every executor has.
    """
    small_batches(docs.sparkSession)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_column]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(rest.alias("rest"), F.col(f"`{text_column}`").cast("string").alias("text"))
    schema = StructType([rows.schema["rest"], StructField("ids", BinaryType()), StructField("decoded", StringType())])
    return rows.mapInArrow(tokenizer(path), schema)
