"""Byte-pair encoding without merge loops, and decoding through an offset table.

Encoder (exact, linear time): an Aho-Corasick automaton over all token byte
strings gives the longest token at each position of a chunk. A left-to-right
walk takes the longest token that may follow its predecessor; where none fits it
steps back one token and tries that token's next shorter prefix. "May follow" is
the pair-compatibility table: two tokens are compatible when the merge rules,
run on their joined bytes, would leave exactly this boundary. A sequence of
self-consistent tokens with compatible neighbours is the one the merge rules
produce, so the result equals that of merging.

Decoder: all token bytes in one blob with offsets; ids become one gather.

Nulls and empty texts give no ids. Special-token strings inside a text are taken
as the special token, as the tokenizers library does by default. Texts of any
length are encoded whole; the per-worker chunk cache is emptied when full, which
only costs time.
"""

from __future__ import annotations

import hashlib
import json
import struct
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quill.llm.tables import map_arrow, text_bytes

DEFAULT_VOCAB = "byte_bpe_50k.json"
CACHE_ENTRIES = 1 << 19

# White space that may stand before a plain space (Unicode White_Space and the
# four ASCII separators); such a space is no safe place to cut.
_BEFORE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                            0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_ASCII_PAIRS = tuple(c + " " for c in _BEFORE if ord(c) < 128)
_ALL_PAIRS = tuple(c + " " for c in _BEFORE)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters stand for themselves, the others for 256, 257, …"""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def safe_parts(text: str) -> list[str]:
    """Cut at single spaces after a visible character. Each part after the first
    has lost that space; no pre-token crosses such a cut."""
    parts = text.split(" ")
    if not any(p in text for p in (_ASCII_PAIRS if text.isascii() else _ALL_PAIRS)) and text[:1] != " ":
        return parts
    out = [parts[0]]
    for p in parts[1:]:
        last = out[-1]
        if not last or last[-1] in _BEFORE:
            out[-1] = last + " " + p
        else:
            out.append(p)
    return out


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Chunks(dict):
    """Part of a text (that followed a space) -> its ids as little-endian uint32 bytes.

    A part of letters alone is one pre-token; one closing mark after letters is
    a pre-token of its own, so such parts share the entry of the bare word.
    """

    def __init__(self, codec):
        super().__init__()
        self.codec = codec
        self.older: dict = {}

    def __missing__(self, part):
        if len(self) >= CACHE_ENTRIES:      # two generations: entries in use move on
            self.older = dict(self)
            self.clear()
        got = self.older.get(part)
        if got is not None:
            self[part] = got
            return got
        word = part[:-1]
        if part.isalpha():
            got = pack(self.codec.encode_piece(" " + part))
        elif word.isalpha() and part[-1] in ".,;:!?":
            got = self[word] + pack(self.codec.encode_piece(part[-1]))
        else:
            got = self.codec.encode_chunk(" " + part)
        self[part] = got
        return got


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in enumerate(byte_alphabet())}
        vocab = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.specials.values()])
        token = [b""] * size
        for s, i in vocab.items():
            token[i] = bytes(to_byte[c] for c in s)
        for s, i in self.specials.items():
            token[i] = s.encode()
        by_bytes = {token[i]: i for i in vocab.values()}
        self.rank = [-1] * size            # -1: a single byte, never merged
        self.halves: list = [None] * size
        self.merged: dict = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            a, b = vocab[a], vocab[b]
            t = by_bytes[token[a] + token[b]]
            self.merged[a, b] = t
            if self.halves[t] is None:
                self.rank[t], self.halves[t] = r, (a, b)
        self.width = [len(t) for t in token]
        self._pairs: dict = {}
        # tokens that the merge rules can produce from their own bytes
        usable = [i for i in vocab.values() if token[i] and (self.halves[i] is None and len(token[i]) == 1
                                                              or self.halves[i] and self.compatible(*self.halves[i], below=self.rank[i]))]
        self.machine = ahocorasick.Automaton()
        for i in usable:
            self.machine.add_word(token[i].decode("latin-1"), i)
        self.machine.make_automaton()
        self.known = known = {token[i].decode("latin-1"): i for i in usable}
        self.shorter: list = [None] * size
        for s, i in known.items():
            self.shorter[i] = next((known[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in known), None)
        self.blob = np.frombuffer(b"".join(token), np.uint8)
        self.length = np.array(self.width, np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.split = regex.compile(pattern)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.chunks = _Chunks(self)

    def compatible(self, a: int, b: int, below: int | None = None) -> bool:
        """Would merging keep the boundary between neighbours a and b?

        Undo the merges of both tokens, latest first, and look at the two parts
        that touch the boundary: had their own merge come before the one undone,
        the boundary would be gone. Among equal ranks the left place merges first.
        ``below`` limits the check to merges of a lower rank (used to test whether
        a token arises from its own halves).
        """
        limit = len(self.merged) if below is None else below
        rank, halves, merged = self.rank, self.halves, self.merged
        while True:
            both = merged.get((a, b))
            if both is not None and rank[both] < limit:
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                limit = rank[a]
                a = halves[a][1]
            else:
                limit = rank[b] + 1
                b = halves[b][0]

    def encode_piece(self, piece: str) -> list[int]:
        """One pre-token."""
        s = piece.encode("utf-8").decode("latin-1")
        whole = self.known.get(s)
        if whole is not None:
            return [whole]
        n, width, shorter, pairs, scan = len(s), self.width, self.shorter, self._pairs, self.machine.iter_long
        if len(pairs) >= CACHE_ENTRIES:
            pairs.clear()
        path: list[int] = []
        dead = None                     # ends from which no way on was found
        at, before = 0, -1
        candidate = next(scan(s))[1]    # every byte is a token: a match starts here
        while True:
            while candidate is not None:
                if before < 0:
                    fits = True
                else:
                    key = before << 20 | candidate
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = self.compatible(before, candidate)
                if fits and not (dead and at + width[candidate] in dead):
                    break
                candidate = shorter[candidate]
            if candidate is not None:
                path.append(candidate)
                at += width[candidate]
                if at == n:
                    return path
                before, candidate = candidate, next(scan(s, at))[1]
            else:                       # nothing may stand here: step back
                dead = dead or set()
                dead.add(at)
                last = path.pop()
                at -= width[last]
                before = path[-1] if path else -1
                candidate = shorter[last]

    def encode_chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in self.split.findall(chunk):
            ids += self.encode_piece(piece)
        return pack(ids)

    def _encode_plain(self, text: str) -> bytes:
        if not text:
            return b""
        parts = safe_parts(text)
        return self.encode_chunk(parts[0]) + b"".join(map(self.chunks.__getitem__, parts[1:]))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian uint32 bytes."""
        if self.special_split is None or not any(s in text for s in self.specials):
            return self._encode_plain(text)
        return b"".join(pack([self.specials[s]]) if s in self.specials else self._encode_plain(s)
                        for s in self.special_split.split(text))

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Token bytes of the ids, joined: one gather through the offset table."""
        n = self.length[ids]
        start = np.cumsum(n) - n
        total = int(n.sum())
        at = np.repeat(self.offset[ids] - start, n)
        at += np.arange(total)
        return self.blob[at].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(vocab: str = DEFAULT_VOCAB, pattern: str | None = None) -> Codec:
    """The worker's codec; ``vocab`` is a path, or a file name of the installed vocabularies."""
    import os

    import public_tokenizers
    return Codec(vocab if os.path.sep in vocab else public_tokenizers.path(vocab), pattern or public_tokenizers.PATTERN)


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", vocab: str = DEFAULT_VOCAB) -> DataFrame:
    """(key, ids array<int>, decoded string) of each row; rows repeat as they come."""
    def run(batches):
        c = codec(vocab)
        for b in batches:
            ids, back = [], []
            for t in b.column(1).to_pylist():
                got = np.frombuffer(c.encode(t.decode("utf-8", "replace")), "<u4")
                ids.append(got.astype(np.int32))
                back.append(c.decode(got))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.string())], names=[key, "ids", "decoded"])
    kind = dict(df.dtypes)[key]
    return map_arrow(df.select(key, text_bytes(text).alias("text")), run, f"{key} {kind}, ids array<int>, decoded string")


def encoding_digests(df: DataFrame, key: str = "doc_id", text: str = "text", vocab: str = DEFAULT_VOCAB) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encode and decode each whole
    text inside the task and return digests of both, so no ids leave the worker."""
    def run(batches):
        c = codec(vocab)
        for b in batches:
            n, one, two = [], [], []
            for t in b.column(1).to_pylist():
                ids = np.frombuffer(c.encode(t.decode("utf-8", "replace")), "<u4")
                n.append(len(ids))
                one.append(hashlib.sha256(str(ids.tolist())[1:-1].replace(" ", "").encode()).hexdigest())
                raw = c.decode_bytes(ids)
                if raw != t:            # invalid input: replacement characters as in the text form
                    raw = raw.decode("utf-8", "replace").encode()
                two.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(one), pa.array(two)],
                                             names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])
    kind = dict(df.dtypes)[key]
    return map_arrow(df.select(key, text_bytes(text).alias("text")), run, f"{key} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


class LibraryCodec:
    """Same ids, encoded by tiktoken over the vocabulary's rank file, without a cache.
    For stages that need ids quickly and are not about the encoder itself."""

    def __init__(self, ranks_path: str, pattern: str, special: str, special_id: int):
        import base64

        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.one = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special, self.special_id = special, pack([special_id])

    def encode(self, text: str) -> bytes:
        return self.special_id.join(np.array(self.one(t), "<u4").tobytes() for t in text.split(self.special))


@lru_cache(maxsize=2)
def library_codec(ranks: str = "byte_bpe_50k.tiktoken", special: str = "<|endoftext|>", special_id: int = 50256) -> LibraryCodec:
    import os

    import public_tokenizers
    return LibraryCodec(ranks if os.path.sep in ranks else public_tokenizers.path(ranks), public_tokenizers.PATTERN, special, special_id)
