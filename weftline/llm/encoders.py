"""Exact ids of whole texts from public vocabularies, with the merges done once per distinct piece of text.

A vocabulary's pattern cuts a text before any merge at places that depend on nearby characters only, so a text is the
concatenation of pieces that can be encoded alone:

* byte-level: a space between two characters that aren't white space begins a piece;
* word-end: ASCII white space ends a piece and is dropped.

A batch is cut and its distinct pieces are numbered by Arrow; ids of distinct pieces come from a bounded memory or are
worked out together; the ids of all texts are then gathered in numpy. Texts in which a space stands before other white
space are encoded whole by the library.

Pieces of Latin letters are merged by tiktoken over the same vocabulary, in one call for all new pieces; others, where
Unicode tables of two libraries might differ, by the tokenizers library. The bound of the memory changes speed only.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Pieces that are remembered, and the longest of them. Byte-level pieces are quick to merge: more than so many gain nothing.
LIMIT, BYTE_LIMIT, LONGEST = 250_000, 50_000, 48
#: Up to here, letters and case are the same in every Unicode version.
LATIN = "ɏ"


class Encoded:
    """Ids of a batch of texts: `ids` of all, `ends` of each text among them."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self.ids, self.ends = ids, ends

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    def split(self) -> list[np.ndarray]:
        return np.split(self.ids, self.ends[:-1]) if len(self.ends) else []


class PieceEncoder:
    """What both kinds share. Subclasses say how to cut, and how to encode new pieces and whole texts."""

    spaced = True  # pieces but the first stand after a space, which belongs to them

    def __init__(self, limit: int = LIMIT) -> None:
        self.limit = limit
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, as little-endian unsigned 32-bit bytes."""
        raise NotImplementedError

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, or of pieces that start a text."""
        raise NotImplementedError

    def numbered(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(number of each piece, end of each text among the pieces, ids of each number)."""
        column = column.cast(pa.large_string())
        lists = pc.split_pattern(column, " ") if self.spaced else pc.ascii_split_whitespace(column)
        ends = lists.offsets.to_numpy().astype(np.int64)
        first, ends = ends[0], ends[1:] - ends[0]
        encoded = lists.values.slice(first, int(ends[-1]) if len(ends) else 0).dictionary_encode()
        if isinstance(encoded, pa.ChunkedArray):
            encoded = encoded.combine_chunks()
        number, pieces = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        starts = np.append(0, ends[:-1]) if len(ends) else ends
        odd_texts = np.zeros(0, np.int64)
        lead: list[int] = []
        if self.spaced:
            head = pc.utf8_slice_codeunits(encoded.dictionary, 0, 1)
            odd = pc.or_(pc.utf8_is_space(head), pc.equal(head, "")).to_numpy(zero_copy_only=False)
            hit = odd[number]
            hit[starts] = False
            odd_texts = np.unique(np.searchsorted(ends, np.flatnonzero(hit), "right"))
            lead = starts.tolist()
        values = self._values(pieces, number, starts)
        if not self.spaced:
            return number, ends, values
        # Each text's first piece has a number of its own; an odd text is that piece as a whole.
        heads = [pieces[i] for i in number[starts].tolist()]
        texts = column.take(pa.array(odd_texts)).to_pylist()
        for i, t in zip(odd_texts.tolist(), texts, strict=True):
            heads[i] = t
        distinct = list(dict.fromkeys(heads))
        at = {h: len(values) + i for i, h in enumerate(distinct)}
        values = values + self.whole(distinct)
        number[lead] = [at[h] for h in heads]
        if len(odd_texts):
            keep = np.ones(len(number), bool)
            for i in odd_texts.tolist():
                keep[starts[i] + 1 : ends[i]] = False
            gone = np.cumsum(~keep)
            ends = ends - gone[ends - 1]
            number = number[keep]
        return number, ends, values

    def _values(self, pieces: list[str], number: np.ndarray, starts: np.ndarray) -> list[bytes]:
        known = self.known
        values = list(map(known.get, pieces))
        new = [i for i, v in enumerate(values) if v is None]
        if new:
            fresh = [pieces[i] for i in new]
            if len(known) + len(new) > self.limit:
                known.clear()
            room = self.limit - len(known)
            for i, p, v in zip(new, fresh, self.learn(fresh), strict=True):
                values[i] = v
                if room and len(p) <= LONGEST:
                    known[p] = v
                    room -= 1
        return values

    def encode(self, column: pa.Array) -> Encoded:
        number, ends, values = self.numbered(column)
        return gather(number, ends, values)

    def count(self, column: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        number, ends, values = self.numbered(column)
        size = np.fromiter(map(len, values), np.int64, len(values)) // 4
        total = np.append(0, np.cumsum(size[number]))
        return np.diff(total[ends], prepend=0)


def gather(number: np.ndarray, ends: np.ndarray, values: list[bytes]) -> Encoded:
    pool = np.frombuffer(b"".join(values), np.uint32)
    size = np.fromiter(map(len, values), np.int64, len(values)) // 4
    where = np.cumsum(size) - size
    n = size[number]
    total = np.append(0, np.cumsum(n))
    at = np.repeat(where[number] - total[:-1], n)
    at += np.arange(len(at))
    return Encoded(pool[at], total[ends])


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # the strings of special tokens in a text are ordinary text
    return t


def _byte_of() -> dict[str, int]:
    """The characters by which tokenizers files write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _slices(ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
    raw, at = ids.tobytes(), (np.append(starts, len(ids)) * 4).tolist()
    return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]


class ByteLevel(PieceEncoder):
    """Byte-level BPE in a tokenizers file."""

    def __init__(self, path: str, limit: int = BYTE_LIMIT) -> None:
        super().__init__(limit)
        import public_tokenizers
        import tiktoken

        self.tokenizer = _tokenizer(path)
        byte = _byte_of()
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if all(c in byte for c in t) and not t.startswith("<|")}
        self.merges = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.begins = np.zeros(max(vocab.values()) + 1, bool)
        self.begins[[i for t, i in ranks.items() if t[:1] == b" "]] = True

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> list[bytes]:
        latin = [bool(p) and not p[0].isspace() and max(p) <= LATIN for p in pieces]
        easy = [p for p, ok in zip(pieces, latin, strict=True) if ok]
        hard = [" " + p for p, ok in zip(pieces, latin, strict=True) if not ok]
        ids = np.asarray(self.merges.encode_to_numpy(" " + " ".join(easy), disallowed_special=()) if easy else [], np.uint32)
        got, others = iter(_slices(ids, np.flatnonzero(self.begins[ids]))), iter(self.whole(hard) if hard else [])
        return [next(got if ok else others) for ok in latin]


class WordEnd(PieceEncoder):
    """BPE with word ends in a tokenizers file. For tiktoken, a zero byte stands for the end of a word."""

    spaced = False

    def __init__(self, path: str, limit: int = LIMIT) -> None:
        super().__init__(limit)
        import tiktoken

        self.tokenizer = _tokenizer(path)
        byte = _byte_of()
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        ranks = {}
        for t, i in vocab.items():
            stem = t.removesuffix("</w>")
            if all(c in byte for c in stem) and not t.startswith("<|"):
                ranks[bytes(byte[c] for c in stem) + b"\0" * (stem != t)] = i
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        self.merges = tiktoken.Encoding("pieces", pat_str=r"[^\x00\x01]+\x00|\x01", mergeable_ranks=ranks, special_tokens={})
        self.separator = ranks[b"\x01"]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> list[bytes]:
        latin = [bool(p) and max(p) <= LATIN and min(p) > " " for p in pieces]
        easy = [p for p, ok in zip(pieces, latin, strict=True) if ok]
        hard = [p for p, ok in zip(pieces, latin, strict=True) if not ok]
        found: list[bytes] = []
        if easy:
            text = self._marked(easy)
            ids = np.asarray(self.merges.encode_to_numpy(text, disallowed_special=()), np.uint32)
            marks = np.flatnonzero(ids == self.separator)
            found = _slices(np.delete(ids, marks), marks - np.arange(len(marks)))
        got, others = iter(found), iter(self.whole(hard) if hard else [])
        return [next(got if ok else others) for ok in latin]

    def _marked(self, pieces: list[str]) -> str:
        """A separator before each piece, a zero after each word; white space within a piece (U+00A0, say) falls away."""
        lowered = "\n".join(pieces).lower().split("\n")
        plain = [p.isalpha() for p in lowered]
        return "".join(["\x01" + (p + "\0" if ok else "".join([w + "\0" for w in self.words.findall(p)])) for p, ok in zip(lowered, plain, strict=True)])


@lru_cache(maxsize=4)
def encoder(kind: str, path: str) -> PieceEncoder:
    """One per worker process and vocabulary, kept between tasks."""
    return WordEnd(path, 2 * LIMIT) if kind == "word" else {"byte": ByteLevel}[kind](path)  # words take less room than pieces
