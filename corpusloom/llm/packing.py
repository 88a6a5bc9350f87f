"""Packing of token sequences as vector bin packing, for instruction data.

Each sequence has three limits at once: tokens, segments, and loss-bearing tokens.  A piece of an example is a vector of
its three demands; of the pieces that fit an open sequence, the one with the largest dot product of demand and free room
(both as shares of the limits) goes in.  When none fits, a piece is cut to the room that is left.  A sequence that a
limit closes before its token limit, and the last one of a partition, is laid out anew as sequences whose lengths are
powers of two, which need no padding.

Work is local to the partitions of the scan: no shuffle, and a lost task makes the same pieces again.  A worker holds a
pool of POOL_TOKENS tokens and one example at most.

Edge cases: a null text is an empty one and has the end id alone.  Without an end id, an empty text gives no pieces.
Null and repeated doc_ids are kept; rows are told apart by themselves.  Further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, spread

POOL_TOKENS = 1 << 20
#: Shares of loss-bearing tokens in steps of a quarter; each step has its own list of pieces, and so have pieces that bear
#: loss in all tokens.
STEPS = 4


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 256
    loss: int = 4096


#: What the registered query and the pipeline use: a full sequence has 32 tokens of prompt at least.
INSTRUCTION = Limits(4096, 256, 4064)


@dataclass(frozen=True)
class Piece:
    """Ids a..b of an example; ids from loss_from on bear loss."""

    tokens: int
    order: int
    doc: object
    ids: bytes
    a: int
    b: int
    loss_from: int

    @property
    def loss(self) -> int:
        return max(0, self.b - max(self.a, self.loss_from))

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """The first n ids, and the others."""
        at = self.a + n
        return (
            Piece(n, self.order, self.doc, self.ids, self.a, at, self.loss_from),
            Piece(self.tokens - n, self.order, self.doc, self.ids, at, self.b, self.loss_from),
        )

    def most(self, tokens: int, loss: int) -> int:
        """How many of its first ids have at most so many tokens and loss-bearing tokens."""
        free = max(0, self.loss_from - self.a)
        return min(self.tokens, tokens, free + loss)


class Packer:
    """Takes examples one by one and gives finished sequences: lists of pieces."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.pool: list[list[tuple[int, int, int, Piece]]] = [[] for _ in range(STEPS + 2)]
        self.pooled = self.seen = 0

    def _put(self, piece: Piece) -> None:
        step = -(-STEPS * piece.loss // piece.tokens) + (piece.loss == piece.tokens)
        insort(self.pool[step], (piece.tokens, piece.order, piece.a, piece))
        self.pooled += piece.tokens

    def _take(self, step: int, i: int) -> Piece:
        piece = self.pool[step].pop(i)[-1]
        self.pooled -= piece.tokens
        return piece

    def add(self, doc: object, ids: bytes, loss_from: int = 0) -> Iterator[list[Piece]]:
        n = len(ids) // 4
        self.seen += 1
        if n:
            rest = Piece(n, self.seen, doc, ids, 0, n, loss_from)
            while rest is not None and rest.tokens >= self.limits.tokens and rest.most(self.limits.tokens, self.limits.loss) == self.limits.tokens:
                if rest.tokens == self.limits.tokens:
                    whole, rest = rest, None
                else:
                    whole, rest = rest.cut(self.limits.tokens)
                yield [whole]
            if rest is not None:
                self._put(rest)
        while self.pooled > POOL_TOKENS:
            yield from self._sequence()

    def finish(self) -> Iterator[list[Piece]]:
        while self.pooled:
            yield from self._sequence()

    def _best(self, tokens: int, segments: int, loss: int) -> tuple[int, int] | None:
        """Of the longest pieces that fit, one a list of loss shares, the place of the one with the largest dot product."""
        lim, best, found = self.limits, -1.0, None
        for step, pieces in enumerate(self.pool):
            if not pieces:
                continue
            # Of the pieces of a step at least step - 1 quarters of the tokens bear loss; in the last list all of them.
            most = tokens if step < 2 else min(tokens, loss if step > STEPS else STEPS * loss // (step - 1))
            i = bisect_right(pieces, most, key=lambda x: x[0]) - 1
            while i >= 0 and pieces[i][-1].loss > loss:
                i -= 1
            if i >= 0:
                x = pieces[i][-1]
                dot = x.tokens * tokens / lim.tokens**2 + segments / lim.segments**2 + x.loss * loss / lim.loss**2
                if dot > best:
                    best, found = dot, (step, i)
        return found

    def _cut(self, tokens: int, loss: int) -> Piece | None:
        """The first ids of the piece that gives most of them within the room that is left."""
        best, at = 0, None
        for step, pieces in enumerate(self.pool):
            if pieces and (n := pieces[-1][-1].most(tokens, loss)) > best:
                best, at = n, step
        if at is None:
            return None
        first, rest = self._take(at, -1).cut(best)
        self._put(rest)
        return first

    def _sequence(self) -> Iterator[list[Piece]]:
        lim = self.limits
        out: list[Piece] = []
        tokens, loss = lim.tokens, lim.loss
        while tokens and len(out) < lim.segments:
            place = self._best(tokens, lim.segments - len(out), loss)
            piece = self._take(*place) if place else self._cut(tokens, loss)
            if piece is None:
                break
            out.append(piece)
            tokens -= piece.tokens
            loss -= piece.loss
        yield from [out] if tokens == 0 else powers_of_two(out)


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The same ids in sequences whose lengths are the powers of two that add up to theirs."""
    left = sum(x.tokens for x in pieces)
    waiting = pieces[::-1]
    while left:
        room = want = 1 << (left.bit_length() - 1)
        out = []
        while room:
            piece = waiting.pop()
            if piece.tokens > room:
                piece, rest = piece.cut(room)
                waiting.append(rest)
            out.append(piece)
            room -= piece.tokens
        left -= want
        yield out


def first_line(text: str | None) -> str:
    """The first line of a text of several lines."""
    return text[: text.index("\n")] if text and "\n" in text else ""


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int | None = None, limits: Limits = Limits(), loss_start: str | None = None, keep_ids: bool = False, prompt_line: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens, sequence_tokens,
    and with keep_ids the ids themselves (binary, little-endian unsigned 32-bit).

    The leading ids of an example, its prompt, bear no loss.  loss_start names a column with their count (null: 0); with
    prompt_line they are as many as the first line has by itself, if the text has several lines.  With neither all ids bear
    loss.
    """
    import pyarrow as pa

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens", "sequence_tokens"] + ["ids"] * keep_ids
    schema = f"doc_id {kind.simpleString()}, " + ", ".join(f"{x} long" for x in names[1:9]) + ", ids binary" * keep_ids

    def examples(batches: Iterable, encode) -> Iterator[tuple]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                ids, starts, parts = (some.column(i).to_pylist() for i in (0, 2, 3))
                texts = some.column(1)
                if prompt_line:
                    starts = [len(x) // 4 for x in encode(list(map(first_line, texts.to_pylist())))]
                for doc, raw, start, part in zip(ids, encode(texts), starts, parts, strict=True):
                    yield doc, raw + end, start, part

    def pack(batches):
        from .tokens import encoder

        packer, n, part, rows, id_type = Packer(limits), 0, 0, [], None

        def table(rows):
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:9]), *(pa.array(c, pa.binary()) for c in columns[9:])], names)

        def placed(sequence, number):
            offset, total = 0, sum(x.tokens for x in sequence)
            for x in sequence:
                raw = x.ids[4 * x.a : 4 * x.b]
                yield (x.doc, x.a, x.tokens, zlib.crc32(raw), len(x.ids) // 4, number, offset, x.loss, total, *([raw] if keep_ids else []))
                offset += x.tokens

        def sequences():
            nonlocal part

            def noted():
                nonlocal id_type
                for batch in batches:
                    id_type = batch.schema.field(0).type
                    yield batch

            for doc, raw, start, part in examples(noted(), encoder(tokenizer).encode):
                yield from packer.add(doc, raw, start)
            yield from packer.finish()

        for sequence in sequences():
            rows += placed(sequence, (part << 32) + n)
            n += 1
            if len(rows) >= 2000:
                yield table(rows)
                rows = []
        if rows:
            yield table(rows)

    start = F.coalesce(F.col(loss_start).cast("long"), F.lit(0)) if loss_start else F.lit(0).cast("long")
    source = docs.select("doc_id", "text", start.alias("__start"), F.spark_partition_id().cast("long").alias("__part"))
    return source.mapInArrow(pack, schema)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all documents in sequences of at most 4096 tokens, 256 segments and 4064 loss-bearing tokens; the
    first line of a document is its prompt."""
    import public_tokenizers

    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, limits=INSTRUCTION, prompt_line=True)
