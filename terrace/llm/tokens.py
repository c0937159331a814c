"""Encoding texts with fixed vocabularies inside Spark tasks.

A word's ids do not depend on the words around it, so each task keeps a bounded memo of pieces already encoded:
pieces are cut at spaces, where none of the vocabularies' patterns joins what stands on either side.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import json
import os
import re
import struct
import unicodedata
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame, types as T

from .common import map_batches

#: Entries that a memo holds before it starts anew.
MEMO = 200_000
#: The same for ByteBPE, where a miss costs some 15 microseconds; keys and values of its two memos are mostly the same objects.
BPE_MEMO = 600_000
# Fixed value: how byte-level files cut text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: how files with word ends cut text, lower-cased by then.
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A space or line end before more white space or at the end: there, whole runs of white space belong together.
UNSAFE_SPACE, UNSAFE_LINE = re.compile(r" (?:\s|\Z)"), re.compile(r"\n(?:\s|\Z)")


class Memo(dict):
    """Piece -> ids as little-endian unsigned 32-bit integers, by encode(piece) on a miss. Holds what the last pieces needed: a full memo becomes the old one, and what is asked of that moves up."""

    def __init__(self, encode: Callable[[str], bytes], most: int = MEMO):
        self.encode, self.half, self.old = encode, most // 2, {}

    def __missing__(self, piece):
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        ids = self.old.pop(piece, None)
        if ids is None:
            ids = self.encode(piece)
        self[piece] = ids
        return ids

    def ids(self, pieces: list) -> bytes:
        return b"".join(map(self.__getitem__, pieces))


def spaced(text: str) -> list[str] | None:
    """Pieces of a text that a byte-level pattern never joins: each begins at a space or a line end. None: cut it by the pattern itself."""
    if UNSAFE_SPACE.search(text):
        return None
    first, *rest = (text if UNSAFE_LINE.search(text) else text.replace("\n", " \n")).split(" ")
    return [first] * bool(first) + [p if p[:1] == "\n" else " " + p for p in rest]


#: The rank table's pattern matching has no stack for long runs of white space; texts with one go to the library.
LONG_BLANK = re.compile(r"\s{500}")
#: End-of-word mark inside rank tables: matches have no space.
WORD_END = b" "
#: Texts of Latin-1 characters that normalising changes one by one, by FOLDED: these are cut without the library.
PLAIN = re.compile(r"[\t-\r -~\u00a1-\u00ff]*")
#: Stands for a word that is not plain, among plain ones.
ODD = "\0"
SPACE, LETTER, NUMBER, OTHER = range(4)
_KIND = {"L": LETTER, "N": NUMBER, "Z": SPACE}
KINDS = np.array([SPACE if 9 <= i <= 13 else _KIND.get(unicodedata.category(chr(i))[0], OTHER) for i in range(256)], np.uint8)
FOLDED = np.array([32 if KINDS[i] == SPACE else ord(chr(i).lower()) for i in range(256)], np.uint8)
#: A short form is a match of its own where no run of other characters takes its apostrophe.
SHORT = re.compile(b"(?<![" + re.escape(bytes(np.flatnonzero(KINDS == OTHER).tolist())) + b"])'(?:[stmd]|re|ve|ll)")


def ended(text: str) -> str:
    """The matches of WORD_LEVEL in a plain text, lower-cased, each with WORD_END behind it. More spaces may stand between them."""
    held = FOLDED[np.frombuffer(text.encode("latin-1"), np.uint8)]
    kinds, begins = KINDS[held], np.zeros(len(held) + 1, bool)
    begins[1:-1] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
    folded = held.tobytes()
    if b"'" in folded:
        for found in SHORT.finditer(folded):
            begins[found.start() + 1], begins[found.end()] = False, True
    begins[-1] = True
    return np.insert(held, np.flatnonzero(begins), 32).tobytes().decode("latin-1")


def byte_of_char() -> dict[str, int]:
    """The characters that byte-level files write for bytes: printable Latin-1 stands for itself, the others follow from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


def merge_ranks(model: dict) -> dict[bytes, int] | None:
    """Byte strings to ids of a byte-level BPE file, if its ids tell the order of its merges too: single bytes (and word ends) first, then a merge's result after that of the merge before. Then the pair of least rank is the pair whose result has the least id, and ids and ranks are one table. None: they are not."""
    byte, suffix = byte_of_char(), model.get("end_of_word_suffix") or ""
    made = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in made or any(x >= y for x, y in itertools.pairwise(made)) or len(model["vocab"]) != len(made) + 256 * (1 + bool(suffix)) or made and made[0] != len(model["vocab"]) - len(made):
        return None
    ends = [t for t in model["vocab"] if suffix and t.endswith(suffix)]
    marked = set(ends)
    ranks = {bytes(byte[c] for c in (t[: -len(suffix)] if t in marked else t)) + WORD_END * (t in marked): i for t, i in model["vocab"].items()}
    # a token's own space may read as an end
    return ranks if len(ranks) == len(model["vocab"]) else None


class Library:
    """A file of the tokenizers library. cut: "space" for byte-level files, "words" for those that drop white space and lower-case.

    Merging is left to a rank table, which gives the same ids as the file's merges in a fraction of the time; what the table can't express goes to the library itself.
    With "words", plain texts go to the table whole; of other texts the plain words do, together, and each word that is not plain goes through a memo.
    """

    def __init__(self, path: str, cut: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tool, self.cut = Tokenizer.from_file(path), cut
        self.tool.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        ranks = merge_ranks(stated["model"])
        self.table = None
        if ranks is not None and cut == "space" and (stated.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not stated.get("normalizer"):
            self.table = tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        elif ranks is not None and cut == "words" and stated["model"].get("end_of_word_suffix") and stated["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == WORD_LEVEL:
            self.odd = max(ranks.values()) + 1
            self.table = tiktoken.Encoding("file", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={ODD: self.odd})
        self.memo = Memo(self.piece)

    def piece(self, piece: bytes) -> bytes:
        """A word between white space. A letter and the full stop or comma that ends it are matches of their own, unless lower-casing puts a mark after the letter."""
        text = piece.decode()
        if text[-1:] in (".", ",") and text[-2:-1].lower().isalpha():
            return self.memo[piece[:-1]] + self.memo[piece[-1:]]
        return self.merged(text) if self.table is not None and PLAIN.fullmatch(text) else self.whole(text)

    def merged(self, text: str) -> bytes:
        """The ids of a plain text; self.odd where it has ODD."""
        return self.table.encode_to_numpy(ended(text), allowed_special={ODD}, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def mixed(self, text: str) -> bytes:
        """The ids of a text with words that are not plain."""
        words = b" ".join(text.encode().lower().split()).decode().split(" ")
        plain = list(map(PLAIN.fullmatch, words))
        ids = self.merged(" ".join([word if ok else ODD for word, ok in zip(words, plain, strict=True)]))
        out, at = [], 0
        for place, word in zip((4 * np.flatnonzero(np.frombuffer(ids, "<u4") == self.odd)).tolist(), (word for word, ok in zip(words, plain, strict=True) if not ok), strict=True):
            out += ids[at:place], self.memo[word.encode()]
            at = place + 4
        return b"".join(out) + ids[at:]

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tool.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.cut == "words":
            if self.table is None:
                return self.memo.ids(text.encode().lower().split())
            return self.merged(text) if PLAIN.fullmatch(text) else self.mixed(text)
        if self.table is None or LONG_BLANK.search(text):
            return self.whole(text)
        return np.asarray(self.table.encode_ordinary(text), "<u4").tobytes()


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PerfectHash:
    """Minimal perfect hash of fixed keys (hash, displace): n keys in n slots. find() says a key's value, or None for any other key.

    Keys go to buckets by one hash. Buckets, largest first, get the displacement under which their keys meet free slots only; a bucket of one key gets a free slot itself, kept as a negative number.
    """

    def __init__(self, items: dict[bytes, int]):
        n = self.n = len(items)
        self.buckets = max(1, n // 3)
        groups: list[list[tuple[int, bytes]]] = [[] for _ in range(self.buckets)]
        for key in items:
            h = xxhash.xxh3_64_intdigest(key)
            groups[h % self.buckets].append((h, key))
        self.keys: list[bytes | None] = [None] * n
        self.values = [0] * n
        self.shift = [0] * self.buckets
        order = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        free = None
        for b in order:
            group = groups[b]
            if len(group) > 1:
                d = 0
                while len(slots := {self.slot(h, d) for h, _ in group}) < len(group) or any(self.keys[s] is not None for s in slots):
                    d += 1
                self.shift[b] = d
                for h, key in group:
                    self.put(self.slot(h, d), key, items[key])
            elif group:
                free = iter([s for s in range(n) if self.keys[s] is None]) if free is None else free
                s = next(free)
                self.shift[b] = -s - 1
                self.put(s, group[0][1], items[group[0][1]])

    def put(self, slot: int, key: bytes, value: int) -> None:
        self.keys[slot], self.values[slot] = key, value

    def slot(self, h: int, d: int) -> int:
        return ((h >> 20) * (2 * d + 1) + d * 0x9E3779B97F4A7C15 >> 7) % self.n

    def find(self, key: bytes) -> int | None:
        if not self.n:
            return None
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        s = -d - 1 if d < 0 else self.slot(h, d)
        return self.values[s] if self.keys[s] == key else None


class ByteBPE:
    """Byte-level BPE by a rank file. Whole pre-tokens are found by the perfect hash; the others are merged with a heap over linked bytes."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = load_ranks(path)
        self.hash = PerfectHash(self.ranks)
        self.split = regex.compile(pattern).findall
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.matches, self.memo = Memo(self.match, BPE_MEMO), Memo(self.piece, BPE_MEMO)

    def encode(self, text: str) -> bytes:
        pieces = spaced(text)
        return self.matches.ids(self.split(text)) if pieces is None else self.memo.ids(pieces)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def piece(self, piece: str) -> bytes:
        found = self.split(piece)
        return self.matches[piece] if found == [piece] else self.matches.ids(found)

    def match(self, piece: str) -> bytes:
        key = piece.encode()
        whole = self.hash.find(key)
        return struct.pack("<I", whole) if whole is not None else packed(self.merge(key))

    def merge(self, key: bytes) -> list[int]:
        """Merges the pair of least rank, the leftmost of equals, until none has a rank."""
        n, ranks = len(key), self.ranks
        end = list(range(1, n + 1))  # of the part that begins here; 0: it was merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(key[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != to or not end[middle]:
                continue
            end[i], end[middle] = to, 0
            if to < n:
                before[to] = i
                if (r := ranks.get(key[i : end[to]])) is not None:
                    heapq.heappush(heap, (r, i, end[to]))
            if (p := before[i]) >= 0 and (r := ranks.get(key[p:to])) is not None:
                heapq.heappush(heap, (r, p, to))
        out, i = [], 0
        while i < n:
            out.append(ranks[key[i : end[i]]])
            i = end[i]
        return out


_tools: dict[tuple, object] = {}


def tool(make: type, *args: str):
    """One tool a Python worker, kept between tasks."""
    if (make, args) not in _tools:
        _tools[make, args] = make(*args)
    return _tools[make, args]


def map_tool(df: DataFrame, which: tuple, per_row: Callable[..., tuple], inputs: list[str], fields: list[tuple[str, T.DataType]], drop: tuple[str, ...] = ()) -> DataFrame:
    """map_batches() with the worker's tool (make, *args) as first argument."""
    return map_batches(df, per_row, inputs, fields, setup=lambda: tool(*which), drop=drop)
