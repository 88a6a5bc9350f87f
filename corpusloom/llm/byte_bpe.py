"""Byte-level BPE by Aho-Corasick and backtracking.

The vocabulary's byte strings, written as Latin-1, make a pyahocorasick trie.  A word is encoded from the left: the
longest token that starts here is taken if it is compatible with the token before it, that is, if byte-pair merging
of the two tokens' bytes side by side leaves exactly the two; else the next shorter one is tried, and if none is left the
token before is given up and replaced by a shorter one.  A position that was given up once is never entered again, so the
work is linear in the word's length.  Adjacent compatibility decides the whole: a sequence whose neighbours are all
compatible is the one that merging yields.  Compatibility of a pair is remembered, within a bound.
"""

from __future__ import annotations

import base64
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, spread
from .tokens import PIECE, PROBES

#: Remembered pairs, remembered words, and the longest word that is remembered.
PAIRS, WORDS, LONGEST = 400_000, 500_000, 48
#: Documents of one output batch.
BATCH_DOCS = 250


class ByteBpe:
    """A vocabulary of ranks (bytes -> id; lower ids merge first), as in .tiktoken files."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        if any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("each single byte needs a rank")
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pattern = regex.compile(pattern).findall
        self.stand_ins: dict[int, str] = {}
        # A pattern whose matches never hold a blank behind a word gives the same matches piece by piece; others get whole texts.
        self.by_pieces = all(self.words(x) == [w for piece in PIECE.findall(x) for w in self.words(piece)] for x in PROBES)
        # Tokens that merging never makes from their own bytes are left out: no encoding holds them.
        self.made = {b: i for b, i in ranks.items() if len(b) == 1 or self._merge(b) == [b]}
        self.trie = ahocorasick.Automaton()
        for token, i in self.made.items():
            self.trie.add_word(token.decode("latin-1"), (len(token), i))
        self.trie.make_automaton()
        self.shorter: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def _merge(self, raw: bytes) -> list[bytes]:
        """Byte-pair merging of a short string: lowest rank first, leftmost among equals."""
        parts, none = [raw[i : i + 1] for i in range(len(raw))], 1 << 62
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
            if (rank := min(ranks)) == none:
                break
            at = ranks.index(rank)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of this one; -1 for single bytes."""
        found = self.shorter.get(token)
        if found is None:
            raw = self.bytes_of[token]
            found = self.shorter[token] = next((self.made[raw[:n]] for n in range(len(raw) - 1, 0, -1) if raw[:n] in self.made), -1)
        return found

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of the two leaves exactly the two."""
        fits = self.pairs.get((left, right))
        if fits is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            a, b = self.bytes_of[left], self.bytes_of[right]
            fits = self.pairs[left, right] = self._merge(a + b) == [a, b]
        return fits

    def words(self, text: str) -> list[str]:
        """The matches of the pattern.

        Unicode tables differ by library.  A character that Python's table does not know takes the class that tiktoken
        gives it: it is split as a known character of that class would be.
        """
        if text.isascii() or not (new := [c for c in set(text) if unicodedata.category(c) == "Cn"]):
            return self.pattern(text)
        for c in new:
            if ord(c) not in self.stand_ins:
                self.stand_ins[ord(c)] = tiktoken_class(c)
        out, at = [], 0
        for word in self.pattern(text.translate(self.stand_ins)):
            out.append(text[at : at + len(word)])
            at += len(word)
        return out

    def encode_word(self, word: str) -> list[int]:
        """The ids of one match of the pattern."""
        raw = word.encode()
        if (whole := self.made.get(raw)) is not None:
            return [whole]
        longest = [(0, -1)] * len(raw)
        for end, match in self.trie.iter(raw.decode("latin-1")):
            start = end + 1 - match[0]
            if match[0] > longest[start][0]:
                longest[start] = match
        ids: list[int] = []
        closed, at, token = bytearray(len(raw) + 1), 0, longest[0][1]
        while True:
            end = at + len(self.bytes_of[token])
            if not closed[end] and (not ids or self._compatible(ids[-1], token)):
                ids.append(token)
                if end == len(raw):
                    return ids
                at, token = end, longest[end][1]
            elif (shorter := self._next_shorter(token)) >= 0:
                token = shorter
            else:  # nothing fits here: the token before ends elsewhere
                closed[at] = 1
                token = ids.pop()
                at -= len(self.bytes_of[token])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each whole text as little-endian unsigned 32-bit integers; a null is an empty text."""
        import numpy as np

        out = []
        for text in texts:
            pieces = (PIECE.findall(text) if self.by_pieces else [text]) if text else []
            found = list(map(self.known.get, pieces))
            if None in found:
                for i, ids in enumerate(found):
                    if ids is None and (ids := self.known.get(pieces[i])) is None:
                        ids = np.array([x for word in self.words(pieces[i]) for x in self.encode_word(word)], dtype="<u4").tobytes()
                        if len(pieces[i]) <= LONGEST:
                            self.known[pieces[i]] = ids
                    found[i] = ids
                if len(self.known) > WORDS:
                    self.known.clear()
            out.append(b"".join(found))
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes that little-endian unsigned 32-bit ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))


def tiktoken_class(c: str) -> str:
    """A letter, digit or sign of the same class as c in tiktoken's tables: what it shares a run with, it merges with."""
    import tiktoken

    for known in "a1":
        ranks = {bytes([i]): i for i in range(256)} | {known.encode() + c.encode()[:1]: 256}
        runs = tiktoken.Encoding("runs", pat_str=r"\p{L}+|\p{N}+|[^\p{L}\p{N}]", mergeable_ranks=ranks, special_tokens={})
        if 256 in runs.encode_ordinary(known + c):
            return known
    return "\u00a7"


_loaded: dict[tuple[str, str], ByteBpe] = {}


def vocabulary(path: str, pattern: str) -> ByteBpe:
    """This process's copy of a vocabulary."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBpe.load(path, pattern)
    return _loaded[path, pattern]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, token_ids (binary: little-endian unsigned 32-bit ids), decoded (binary) of each document.

    A null text is an empty one and gives no ids.  Null and repeated doc_ids stay as they are; one row out for each row
    in; further columns are ignored.  Texts of any length are encoded whole.
    """
    import pyarrow as pa

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType

    def encode(batches):
        bpe = vocabulary(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_DOCS):
                part = batch.slice(at, BATCH_DOCS)
                found = bpe.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in found], pa.int64()), pa.array(found, pa.binary()), pa.array(map(bpe.decode, found), pa.binary())],
                    ["doc_id", "n_tokens", "token_ids", "decoded"],
                )

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind.simpleString()}, n_tokens long, token_ids binary, decoded binary")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: every document encoded and decoded, as digests."""
    import public_tokenizers

    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    coded = encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
