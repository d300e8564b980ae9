"""Token ids of whole texts by the tokenizers library, with a memo of chunks.

A text is cut only where every pre-tokenizer used here cuts anyway, so the ids
of the chunks, joined, are the ids of the text. Chunks recur, so most are
looked up, a batch's distinct pieces once each. The memos are bounded: beyond
``limit`` entries new chunks are encoded again in every batch they occur in.
"""

from __future__ import annotations

import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space as the tokenizers see it (Unicode White_Space).
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Letters and digits with the white space before them; closing marks before
# white space or the end (no apostrophe: it may start a contraction); any other
# run without white space; white space at the end.
_CHUNK = re.compile(f"[{_WS}]*[^\\W_]+|[{_WS}]*[^\\w{_WS}']+(?![^{_WS}])|[{_WS}]*[^{_WS}]+|[{_WS}]+")
# White space other than space and line feed, and Python's own separators.
_ODD = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _byte_letters() -> dict[int, int]:
    """Byte -> code point of its letter in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + k for k, b in enumerate(rest)}


_LETTERS = _byte_letters()
_LONG = 48
_CLOSING = ".,;:!?"
_STRETCH = 1 << 16  # pieces gathered at a time


class Encoder:
    """ids of a text as little-endian unsigned 32-bit bytes.

    Texts are split at single spaces by Arrow, and every distinct piece of a
    call is looked up once. ``memo`` has words of letters after a space, and
    ``chunks`` all other chunks and the words beyond; a piece that is not in the
    memo is cut into chunks, and only those that are new too are encoded. The
    texts' ids are then gathered from those of the distinct pieces."""

    def __init__(self, path: str, limit: int = 200_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.limit = limit
        self.memo: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.model = self.tok.model
        self.normalised = self.tok.normalizer is not None
        self.newline = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_new(self, chunk: str) -> bytes:
        """A chunk of letters alone, after at most one space or line feed, is one
        word to the pre-tokenizer and goes to the model directly."""
        lead, core = (chunk[0], chunk[1:]) if chunk[0] in " \n" else ("", chunk)
        if not core.isalpha() or (self.normalised and core != core.lower()):
            return self._whole(chunk)
        letters = core if core.isascii() else core.encode().decode("latin-1").translate(_LETTERS)
        if lead == " " and not self.normalised:
            letters = chr(_LETTERS[32]) + letters
        ids = [t.id for t in self.model.tokenize(letters)]
        ids = struct.pack(f"<{len(ids)}I", *ids)
        return self.newline + ids if lead == "\n" else ids

    @staticmethod
    def _splits(text: str) -> bool:
        """Whether the text can be split at its spaces, for all that a look at
        its white space as a whole tells."""
        return not ("  " in text or "\n " in text or text[:1] == " " or text[-1:] == " ")

    def _gathered(self, rests: list[str | None], word, known) -> tuple[list[bytes], list[int]]:
        """ids of the pieces of each text, which all follow a space; and the
        texts that hold odd white space, whose ids are not right."""
        lists = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        offsets, pieces = lists.offsets.to_numpy(), lists.values.dictionary_encode()
        distinct, which = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy()
        found, odd = list(map(self.memo.get, distinct)), []
        for k, p in enumerate(distinct):
            if found[k] is not None:
                continue
            if p.isalpha():
                found[k] = word(p)
            elif p[-1] in _CLOSING and p[:-1].isalpha():
                found[k] = word(p[:-1]) + known(p[-1])
            elif _ODD.search(p):
                odd.append(k)
                found[k] = b""
            else:
                head, *rest = _CHUNK.findall(p)
                found[k] = b"".join([word(head), *map(known, rest)])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(found), "<u4")
        parts = [np.empty(0, "<u4")]
        for k in range(0, len(which), _STRETCH):
            w = which[k: k + _STRETCH]
            n = sizes[w]
            at = np.repeat(first[w] - (np.cumsum(n) - n), n)
            at += np.arange(len(at))
            parts.append(flat[at])
        ids = np.concatenate(parts)
        cuts = np.concatenate([[0], np.cumsum(sizes[which])])[offsets].tolist()
        strange = np.flatnonzero(np.isin(which, odd)) if odd else []
        rows = np.unique(np.searchsorted(offsets, strange, side="right") - 1).tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], rows

    def encode(self, texts: list[str]) -> list[bytes]:
        extra: dict[str, bytes] = {}  # chunks beyond the memo
        space = "" if self.normalised else " "

        def known(c: str) -> bytes:
            b = self.chunks.get(c)
            if b is None and (b := extra.get(c)) is None:
                b = self._encode_new(c)
                (self.chunks if len(self.chunks) < self.limit and len(c) <= _LONG else extra)[c] = b
            return b

        def word(c: str) -> bytes:
            """A chunk after a space; words of letters fill the memo first."""
            b = self.memo.get(c)
            if b is None:
                if len(self.memo) >= self.limit or len(c) > _LONG or not c.isalpha():
                    return known(space + c)
                b = self.memo[c] = self._encode_new(space + c)
            return b

        def chunked(text: str) -> bytes:
            return b"".join(map(known, _CHUNK.findall(text)))

        heads, rests = [], []
        for t in texts:
            rest = None
            if self.normalised and (not unicodedata.is_normalized("NFC", t) or "\u0130" in t):
                heads.append(self._whole(t))  # characters merge across a cut, or lower case makes one more
            elif not self._splits(t) or _ODD.search(t.partition(" ")[0]):
                heads.append(chunked(t))
            else:
                if self.normalised and "\u03a3" not in t:  # whose lower case depends on its place
                    t = t.lower()
                first, space, rest = t.partition(" ")
                heads.append(chunked(first))
                rest = rest if space else None
            rests.append(rest)
        tails, odd = self._gathered(rests, word, known)
        out = [h + b for h, b in zip(heads, tails)]
        for k in odd:
            out[k] = chunked(texts[k])
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per tokenizer file in a Python worker, reused by its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def texts_of(column, most: int = 4_000_000):
    """The batch's strings in slices of about ``most`` characters (null: empty),
    so a batch of very long texts is not held as Python objects at once."""
    held, size, first = [], 0, 0
    for i, v in enumerate(column):
        b = v.as_buffer().to_pybytes() if v.is_valid else b""
        held.append(b.decode("utf-8", "replace"))
        size += len(b)
        if size >= most:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held
