"""Token ids of whole texts by a public tokenizer file, each distinct word encoded once in a batch.

With a word-level BPE file whose normaliser and splitter never join characters across white space, the ids of a text are
those of its words one after the other. A batch is therefore cut into words with array operations, its distinct words are
looked up in the process's memory of words, only unknown ones go through the tokenizer, and ids are gathered back. The memory
is bounded by `REMEMBERED` words of at most `LONG` bytes; others are encoded in every batch. Use it only with such files
(`tests/llm` compares it with whole texts).

Two rewritings let words share an entry and leave the ids as they are, since the tokenizer lower-cases and separates
letters from punctuation itself: ASCII capitals are lower-cased, and a space goes between an ASCII letter and ASCII
punctuation other than an apostrophe (which may begin a contraction). Batches with a combining mark of the block U+0300
or with ``<|``, which spells special tokens, are left alone.

Unknown words of Latin letters in lower case alone are one piece each for the tokenizer's splitter, and its normaliser leaves them as
they are. They go through the file's BPE model together, separated by spaces; as the model marks the last id of a word, the ids
fall back to their words. Other words, and files of another make, go through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, compress
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa

from gaugeworks.llm.columns import as_bytes

if TYPE_CHECKING:
    from tokenizers import Tokenizer

REMEMBERED = 300_000
LONG = 64

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: By byte: 1 white space, 2 a letter, 3 punctuation but the apostrophe.
_KIND = bytes(1 if b in b" \t\n\v\f\r" else 2 if 0x61 <= b <= 0x7A else 3 if 0x21 <= b < 0x7F and b != 0x27 and not chr(b).isalnum() else 0 for b in range(256))
#: How byte-level models write bytes: printable Latin-1 as itself, the others from U+0100 on; here the space stays a space.
_PRINTED = np.array([0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD for b in range(256)])
_SIGNS = np.where(_PRINTED, np.arange(256), 0xFF + np.cumsum(~_PRINTED)).astype("<u4")
_SIGNS[0x20] = 0x20
#: Lower-case letters that no normaliser changes; a run of them is one piece.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch

_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces, self.last = _pieces(self.tokenizer)
        self.room = remembered
        self.known: dict[bytes, bytes] = {}

    def _new(self, words: list[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        for at in range(0, len(words), 50_000):
            part = words[at : at + 50_000]
            texts = [w.decode("utf-8", "replace") for w in part]
            plain = [bool(self.pieces and _PLAIN(t)) for t in texts]
            if True in plain:
                body = _SIGNS[np.frombuffer(b" ".join(compress(part, plain)), np.uint8)].tobytes().decode("utf-32-le")
                flat = np.array(self.pieces.encode_batch_fast([body], add_special_tokens=False)[0].ids, "<u4")
                ends = np.flatnonzero(self.last[flat]) + 1
                out.update(_cut(list(compress(part, plain)), flat, ends))
            other = [not p for p in plain]
            if True in other:
                encoded = self.tokenizer.encode_batch_fast(list(compress(texts, other)), add_special_tokens=False)
                ids = [e.ids for e in encoded]
                ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
                out.update(_cut(list(compress(part, other)), np.fromiter(chain.from_iterable(ids), "<u4", int(ends[-1])), ends))
        return out

    def _lookup(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        known = self.known
        got = list(map(known.get, words))
        missing = [w for w, g in zip(words, got) if g is None]
        if missing:
            new = self._new(missing)
            got = [new[w] if g is None else g for w, g in zip(words, got)]
            if room := max(0, self.room - len(known)):
                known.update([(w, new[w]) for w in missing if len(w) <= LONG][:room])
        return got

    def encode(self, texts: list[bytes | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts as one array, and where each text begins (one more entry than texts); null is empty.

        With ``end``, that id follows each text.
        """
        sizes = np.array([len(t) if t else 0 for t in texts], np.int64) + 1
        body = b" ".join([t or b"" for t in texts]) + b" "
        if len(body) >= 2**31 - 1:
            raise ValueError("a batch of over 2 GB of text")
        if b"<|" not in body and b"\xcc" not in body and b"\xcd" not in body:
            body = body.translate(_LOWER)
            kind = np.frombuffer(body.translate(_KIND), np.uint8)
            gaps = (np.flatnonzero((kind[:-1] == 2) & (kind[1:] == 3)) + 1).astype(np.int32)
        else:
            kind, gaps = np.frombuffer(body.translate(_KIND), np.uint8), np.zeros(0, np.int32)
        data, space = np.frombuffer(body, np.uint8), kind == 1
        cut = np.ones(len(data) + 1, bool)  # a word begins, or has ended, here
        cut[1:-1] = space[1:] != space[:-1]
        cut[0] = not space[0]
        cut[-1] = False  # the last byte is a space
        cut[gaps] = False  # both: put in twice below
        edges = np.flatnonzero(cut).astype(np.int32)
        if len(gaps):
            edges = np.sort(np.concatenate([edges, gaps, gaps]), kind="stable")  # three ordered runs
        starts, ends = edges[::2], edges[1::2]
        packed = data[~space]
        word_at = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=word_at[1:])
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(word_at), pa.py_buffer(packed)])
        coded = words.dictionary_encode()
        ids = self._lookup(as_bytes(coded.dictionary))
        flat = np.frombuffer(b"".join(ids), "<u4")
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        origins = np.concatenate([[0], np.cumsum(lengths)])
        which = coded.indices.to_numpy(zero_copy_only=False)
        text_ends = np.cumsum(sizes)
        words_to = np.searchsorted(starts, text_ends.astype(np.int32))
        if end is not None:  # the end id is one more word, after the last of each text
            flat = np.concatenate([flat, np.array([end], "<u4")])
            which = np.insert(which, words_to, len(lengths))
            lengths = np.concatenate([lengths, [1]])
            words_to = words_to + np.arange(1, len(texts) + 1)
        counts = lengths.take(which)
        ends = np.cumsum(counts)
        # The place in flat of every id: one more than the last, but where a word begins.
        first = origins.take(which)
        source = np.ones(int(ends[-1]) if len(ends) else 0, np.int64)
        some = counts > 0
        start, begin = (ends - counts)[some], first[some]
        if len(start):
            source[start] = begin
            source[start[1:]] -= begin[:-1] + counts[some][:-1] - 1
        out = flat.take(np.cumsum(source, out=source))
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], words_to])]
        return out, bounds


def _cut(words: list[bytes], flat: np.ndarray, ends: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """Each word with its ids, those of all words being ``flat``."""
    if len(words) != len(ends) or (len(ends) and int(ends[-1]) != len(flat)):
        raise ValueError("the tokenizer's ids don't fall back to words")
    data, to = flat.tobytes(), (ends * 4).tolist()
    return zip(words, map(data.__getitem__, map(slice, [0, *to], to)))


def _pieces(tokenizer: Tokenizer) -> tuple[Tokenizer | None, np.ndarray | None]:
    """The model alone, for words that are one piece each, written in its signs for bytes, and which ids end a word; nothing
    where the model marks no ends."""
    from tokenizers import Tokenizer, pre_tokenizers

    made = json.loads(tokenizer.to_str())
    model = made["model"]
    mark = model.get("end_of_word_suffix")
    before = (made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    by_bytes = before[-1].get("type") == "ByteLevel" and not before[-1].get("add_prefix_space") and not before[-1].get("use_regex")
    if model.get("type") != "BPE" or not mark or not by_bytes or made.get("post_processor"):
        return None, None
    out = Tokenizer(tokenizer.model)
    out.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    last = np.zeros(max(model["vocab"].values()) + 1, bool)
    last[[k for word, k in model["vocab"].items() if word.endswith(mark)]] = True
    return out, last


def encoder(path: str, remembered: int = REMEMBERED) -> WordEncoder:
    """The process's encoder for a file; the first call sets how many words it remembers."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path, remembered)
    return _encoders[path]


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
