"""Tokenizer access for Python workers: one tokenizer a process, and a bounded memory of encoded words."""

from __future__ import annotations

import os
import re
import unicodedata

#: What some vocabularies put behind the last bytes of a word.
WORD_END = "</w>"
#: A piece is a run of blanks and the word after it (or the blanks at a text's end).  A tokenizer whose pre-tokens never hold
#: a blank behind a word gives the same ids for a text as for these pieces one by one, so pieces that recur need no second
#: encoding.  For tokenizers that drop blanks, pieces are the words alone.
BLANKS = " \t\n\r"
PIECE = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: Pieces that one process remembers, the longest piece that it remembers, and those that stay when there are too many.
REMEMBERED, LONGEST, SHORT = 1_000_000, 48, 11
#: New pieces that go to the tokenizer in one call.
GROUP = 2000
#: A tokenizer must give the same ids for these as for their pieces, or it gets whole texts.
PROBES = ("The cat  sat\n\n on the mat. \t 'tis we'll, 12 345-678 a--b _x_ (end)  \n", "Ünïcode çé\u00a0日本語 naïve\r\nİIıi ﬁ\u0301 e\u0301 \u2028 \U0001f600\U0001f600!", " \n lead", "one")


class PieceEncoder:
    """Encodes whole texts with a file of the tokenizers library, as little-endian unsigned 32-bit ids.

    The ids are those of the library's plain call on the whole text: a special token written out in a text is that token.
    Texts with one are encoded whole, as are all texts if the tokenizer does not treat pieces alike.  The memory of pieces
    is emptied when it is full, so a worker's memory stays bounded whatever the texts.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.drops_blanks = not self.tokenizer.encode(" \n ", add_special_tokens=False).ids
        # Where case makes no difference, lower case makes pieces come again more often.
        self.lowers = self.tokenizer.encode("ABC Word").ids == self.tokenizer.encode("abc word").ids
        # Byte-level vocabularies write every byte as one character, and may mark the end of a word.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.byte_lengths = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=np.int64)
        self.byte_lengths[list(vocabulary.values())] = [len(x.removesuffix(WORD_END)) for x in vocabulary]
        self.special = [x.content.lower() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_pieces = True
        self.by_pieces = self.tokenizer.pre_tokenizer is not None and self._pieces_hold()

    def _pieces_hold(self) -> bool:
        try:
            return all(self.encode([x]) == [self._whole(x)] for x in PROBES)
        except (IndexError, ValueError):
            return False
        finally:
            self.known.clear()

    def _whole(self, text: str) -> bytes:
        import numpy as np

        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _has_special(self, text: str) -> bool:
        folded = text.lower()
        return any(x in folded for x in self.special)

    def _whole_ones(self, data, offsets, text_at) -> list[int]:
        """The numbers of texts that are encoded whole: data has the bytes of all, one behind the other."""
        import numpy as np

        sizes = np.diff(offsets)
        if not self.by_pieces:
            return np.flatnonzero(sizes).tolist()
        if not self.special:
            return []
        first = np.zeros(256, dtype=bool)
        for x in self.special:
            # what is lower-cased to a letter may also be another character, of several bytes
            first[[ord(c) for c in {x[0], x[0].upper()} if ord(c) < 128]] = True
            first[128:] |= x[0].isalpha() or ord(x[0]) > 127
        some = np.unique(np.searchsorted(offsets, np.flatnonzero(first[data]), "right") - 1)
        return [i for i in some.tolist() if self._has_special(text_at(i))]

    def _lengths(self, text: str, pieces: list[str]) -> list[int]:
        """Bytes of the pieces that make a text, as the tokenizer sees them, as far as can be told."""
        if text.isascii():
            return list(map(len, pieces))
        if self.tokenizer.normalizer is None:
            return list(map(len, map(str.encode, pieces)))
        return [len(x) if x.isascii() else len(unicodedata.normalize("NFC", x).lower().encode()) for x in pieces]

    def _encode_new(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces, by one call: cut where the bytes of the ids reach the bytes of the pieces.  If they miss any
        of these places, the tokenizer's own record tells which piece an id is from."""
        import numpy as np

        text = (" " if self.drops_blanks else "").join(pieces)
        (got,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(got.ids, dtype="<u4")
        reached, wanted = np.cumsum(self.byte_lengths[ids]), np.cumsum(self._lengths(text, pieces))
        ends = np.searchsorted(reached, wanted, "left") + 1
        if len(ids) != ends[-1] or (reached[ends - 1] != wanted).any():
            (got,) = self.tokenizer.encode_batch([pieces], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(got.ids, dtype="<u4")
            ends = np.searchsorted(np.array(got.word_ids, dtype=np.int64), np.arange(len(pieces)), "right")
        raw, at, out = ids.tobytes(), 0, []
        for end in (4 * ends).tolist():
            out.append(raw[at:end])
            at = end
        return out

    def _encode_all(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of different pieces, by calls of GROUP.  Blanks before a word keep it apart from the word before; bare
        pieces, without them, stand behind a line break of their own, and those that end in blanks go alone."""
        bare = blank = set()
        if not self.drops_blanks:
            bare = {x for x in pieces if x[0] not in BLANKS}
            blank = {x for x in pieces if x[-1] in BLANKS}
        alone = {x: self._encode_new([x])[0] for x in blank}
        row = list(pieces - blank - bare)
        for x in bare:
            row += ("\n", x)
        out: dict[str, bytes] = {}
        for i in range(0, len(row), GROUP):
            part = row[i : i + GROUP]
            out.update(zip(part, self._encode_new(part), strict=True))
        if bare and "\n" not in alone:
            del out["\n"]
        return out | alone

    def _remembered(self, pieces: list[str]) -> list[bytes]:
        """The ids of each of different pieces, known or new."""
        found = list(map(self.known.get, pieces))
        lacking = [i for i, ids in enumerate(found) if ids is None]
        if lacking:
            fresh = self._encode_all({pieces[i] for i in lacking})
            for i in lacking:
                found[i] = fresh[pieces[i]]
            self.known.update((x, ids) for x, ids in fresh.items() if len(x) <= LONGEST)
            if len(self.known) > REMEMBERED:  # short pieces come again more often
                self.known = {x: ids for x, ids in self.known.items() if len(x) <= SHORT}
                if len(self.known) > REMEMBERED // 2:
                    self.known = {}
        return found

    def _cut(self, data, offsets):
        """(pieces of all texts as an Arrow array, how many pieces end with each text) of bytes one behind the other."""
        import numpy as np
        import pyarrow as pa

        is_blank = np.zeros(256, dtype=bool)
        is_blank[list(map(ord, BLANKS))] = True
        blank = is_blank[data]
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[offsets] = True
        edge = begins[:-1].copy()
        edge[1:] |= blank[1:] > blank[:-1]  # a piece begins where blanks do
        if self.drops_blanks:
            word = ~blank
            edge = word.copy()
            edge[1:] &= blank[:-1] | begins[1:-1]
            starts = np.flatnonzero(edge)
            data = data[word]
            ends = np.append(np.cumsum(word)[starts] - 1, len(data)) if len(starts) else np.zeros(1, dtype=np.int64)
        else:
            starts = np.flatnonzero(edge)
            ends = np.append(starts, len(data))
        buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        return pa.Array.from_buffers(pa.large_string(), len(starts), buffers), np.searchsorted(starts, offsets)

    def encode(self, texts) -> list[bytes]:
        """The ids of each text of a list or an Arrow array; a null is an empty text.

        Texts are cut at once, and each different piece is looked up once; what the pieces are is spread by their numbers.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        column = (texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.large_string())).cast(pa.large_string())
        column = pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "")
        sizes = pc.binary_length(column).to_numpy().astype(np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        if not offsets[-1]:
            return [b""] * len(column)
        data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
        begin = int(np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset])
        data = data[begin : begin + int(offsets[-1])]
        whole = {i: self._whole(column[i].as_py()) for i in self._whole_ones(data, offsets, lambda i: column[i].as_py())}
        if whole:  # the others are cut without them
            stays = np.ones(len(sizes), dtype=bool)
            stays[list(whole)] = False
            data, sizes = data[np.repeat(stays, sizes)], np.where(stays, sizes, 0)
            offsets = np.concatenate(([0], np.cumsum(sizes)))
        if self.lowers:
            high = np.concatenate(([0], np.cumsum(data >= 128)))
            ascii_only = np.repeat(high[offsets[1:]] == high[offsets[:-1]], sizes)
            data = data + ((data >= 65) & (data <= 90) & ascii_only) * np.uint8(32)
        pieces, ends = self._cut(data, offsets)
        named = pieces.dictionary_encode()
        found, of = self._remembered(named.dictionary.to_numpy(zero_copy_only=False).tolist()), named.indices.to_numpy(zero_copy_only=False)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        each = lengths[of]
        upto = np.concatenate(([0], np.cumsum(each)))
        source = np.repeat((np.cumsum(lengths) - lengths)[of] - upto[:-1], each) + np.arange(upto[-1])
        raw, cuts = flat[source].tobytes(), (4 * upto[ends]).tolist()
        return [whole[i] if i in whole else raw[cuts[i] : cuts[i + 1]] for i in range(len(sizes))]


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """This process's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
