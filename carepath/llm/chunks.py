"""Token ids of whole texts, with each distinct chunk of text encoded once per task.

A chunk is a piece of text at whose ends the tokenizer cuts anyway (before white space; between
ASCII letters, digits and punctuation), so the ids of a text are
those of its chunks in a row. Most words of a corpus repeat; their ids come from a dictionary
that loses its rare entries when it has grown to CHUNKS entries or CHARACTERS characters. New
chunks are encoded in one call and told apart by the edges of words, or where that is in doubt
by a special token of the vocabulary put between them.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from .wordbytes import BLOCK, SPACE, blocks, text_bytes

CHUNKS = 800_000
CHARACTERS = 16_000_000

#: White space beyond ASCII, or what only some libraries call white space.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: The same in UTF-8.
ODD_BYTES = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
#: Bytes that such characters begin with in UTF-8.
MAYBE_ODD = np.zeros(256, bool)
MAYBE_ODD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
#: ASCII letters 1, digits 2, punctuation 3; an apostrophe may belong to either side.
CLASS = np.zeros(256, np.int8)
CLASS[[*range(65, 91), *range(97, 123)]] = 1
CLASS[48:58] = 2
CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = 3
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = " \t\n\v\f\r"
WHITE_OR_END = {*WHITE, ""}


class _Numbers(dict):
    """Chunk to number; new chunks are noted to be encoded."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        self.fresh.append(chunk)
        return n


class Encoder:
    #: Chunks that are remembered at most; a process with other work beside it may set less than CHUNKS.
    limit = CHUNKS

    def __init__(self, name: str, limit: int = CHUNKS):
        self.limit = limit
        path = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        added = self.tokenizer.get_added_tokens_decoder()
        self.mark, token = max(added.items())
        self.marker = token.content
        self.special = [t.content for t in added.values()]
        pieces = [self.tokenizer.id_to_token(i) or "" for i in range(self.size)]
        #: The end of a word, or white space at the start of a piece: either tells chunks apart.
        self.drops_space = not self._alone(" ")
        self.lowers = self._alone("A") == self._alone("a")
        edge = "</w>" if self.drops_space else "\u0120\u010a\u0109\u010d\u010b\u010c"
        self.edge = np.array([p.endswith(edge) if self.drops_space else p[:1] in edge for p in pieces])
        self.edge[list(added)] = False
        with open(path) as file:
            self.parts = regex.compile(_split_pattern(json.load(file)["pre_tokenizer"]) or "(?!)")
        self._clear()

    def _alone(self, chunk: str) -> list[int]:
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.characters = 0
        self.flat = np.zeros(0, np.uint32)
        # Chunk n has flat[begin[n]:begin[n] + count[n]].
        self.begin = self.count = self.seen = np.zeros(0, np.int64)

    def _prune(self) -> None:
        """Forget the chunks seen once, or all if that doesn't free a third."""
        keep = np.flatnonzero(self.seen > 1)
        chunks = list(self.numbers)
        if 3 * len(keep) > 2 * len(chunks) or self.characters > CHARACTERS:
            self._clear()
            return
        begin, count, seen = self.begin[keep], self.count[keep], self.seen[keep] // 2
        flat = self._gather(begin, count)
        self._clear()
        for i in keep.tolist():
            self.numbers[chunks[i]] = len(self.numbers)
        self.flat, self.begin, self.count, self.seen = flat, np.cumsum(count) - count, count, seen
        self.characters = sum(map(len, self.numbers))

    def _gather(self, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
        to = np.cumsum(count)
        return self.flat[np.arange(to[-1] if len(to) else 0) + np.repeat(begin - to + count, count)]

    def _joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and sizes of chunks encoded as one text, told apart by the edges of words."""
        text = "".join(chunks)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        edges = np.flatnonzero(self.edge[ids])
        if not self.drops_space:
            if len(edges) != len(chunks):
                return None
            return ids, np.diff(edges, append=len(ids))
        words = [1 if c[1:].isalpha() else self._parts(c) for c in chunks]
        last = np.cumsum(words) - 1
        if len(edges) != last[-1] + 1 or min(words) < 1:
            return None
        return ids, np.diff(edges[last], prepend=-1)

    def _parts(self, chunk: str) -> int:
        return len(self.parts.findall(unicodedata.normalize("NFC", chunk).lower()))

    def _marked(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of chunks, kept apart by a special token."""
        text = self.marker.join(chunks)
        if sum(text.count(t) for t in self.special) == len(chunks) - 1:
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.flatnonzero(ids == self.mark)
            return np.delete(ids, cuts), np.diff(cuts, prepend=-1, append=len(ids)) - 1
        ids = [self._alone(c) for c in chunks]  # some hold special tokens themselves
        return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)

    def _learn(self) -> None:
        fresh, self.numbers.fresh = self.numbers.fresh, []
        if not fresh:
            return
        if self.drops_space:
            plain = np.array([c[:1] in WHITE and "<|" not in c and not c.isspace() for c in fresh])
        else:
            plain = np.array(
                [c[0] in WHITE and c[1:2] not in WHITE_OR_END and "<|" not in c and not ODD_SPACE.search(c) for c in fresh]
            )
        first = len(self.begin)
        self.begin = np.append(self.begin, np.zeros(len(fresh), np.int64))
        self.count = np.append(self.count, np.zeros(len(fresh), np.int64))
        self.seen = np.append(self.seen, np.zeros(len(fresh), np.int64))
        for which, way in ((plain, self._joined), (~plain, self._marked)):
            at = np.flatnonzero(which)
            if not len(at):
                continue
            chunks = [fresh[i] for i in at.tolist()]
            ids, sizes = way(chunks) or self._marked(chunks)
            self.begin[first + at] = len(self.flat) + np.cumsum(sizes) - sizes
            self.count[first + at] = sizes
            self.flat = np.append(self.flat, ids)
        self.characters += sum(map(len, fresh))

    def numbered(self, chunks: list[str]) -> np.ndarray:
        """A number for each chunk, valid until the next call of room()."""
        n = np.fromiter(map(self.numbers.__getitem__, chunks), np.int64, len(chunks))
        self._learn()
        self.seen += np.bincount(n, minlength=len(self.seen))
        return n

    def room(self) -> None:
        if len(self.numbers) > min(CHUNKS, self.limit) or self.characters > CHARACTERS:
            self._prune()

    def counts(self, chunks: list[str]) -> np.ndarray:
        """Number of ids of each chunk."""
        self.room()
        n = self.numbered(chunks)
        return self.count[n] if len(n) else np.zeros(0, np.int64)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a column of texts in a row, and the len(texts) + 1 indexes where each begins."""
        raw, offsets = text_bytes(texts)
        flat, ends = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        done = 0
        for i, j in blocks(offsets, 4 * BLOCK):
            self.room()
            n, first, _ = self._number_block(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            count = self.count[n]
            flat.append(self._gather(self.begin[n], count))
            ends.append(done + np.append(0, np.cumsum(count))[first[1:]])
            done += len(flat[-1])
        return np.concatenate(flat), np.concatenate(ends)

    def sizes(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text the characters and the ids of each of its chunks."""
        raw, offsets = text_bytes(texts)
        for i, j in blocks(offsets, 4 * BLOCK):
            self.room()
            part = raw[offsets[i] : offsets[j]]
            n, first, at = self._number_block(part, offsets[i : j + 1] - offsets[i], fine=False)
            chars = np.diff(np.append(0, np.cumsum((part & 0xC0) != 0x80))[at])
            for a, b in zip(first[:-1], first[1:], strict=True):
                yield chars[a:b], self.count[n[a:b]]

    def _number_block(self, raw: np.ndarray, offsets: np.ndarray, fine: bool = True) -> tuple[np.ndarray, ...]:
        """Numbers of the chunks of some texts, the index of each text's first chunk, and cuts.

        Without fine, cuts are before white space only.
        """
        space = SPACE[raw]
        cut = np.zeros(len(raw) + 1, bool)
        cut[1:-1] = space[1:] & ~space[:-1]
        if fine:
            # Special tokens are looked for in the text as it is.
            marked = np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))
            plain = np.ones(len(raw), bool)
            for d in np.unique(np.searchsorted(offsets, marked, "right") - 1):
                plain[offsets[d] : offsets[d + 1]] = False
            kind = CLASS[raw]
            cut[1:-1] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & plain[1:]
            if self.lowers:
                raw = np.where(plain, LOWER[raw], raw)
        if not self.drops_space:
            # White space after other white space may belong to one piece with it.
            if MAYBE_ODD[raw].any():
                after = np.fromiter((m.end() for m in ODD_BYTES.finditer(raw.tobytes())), np.int64)
                cut[after] = False
        cut[offsets] = True
        cut[-1] = True
        at = np.flatnonzero(cut)
        chunks = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(raw)).dictionary_encode()
        known = self.numbered(chunks.dictionary.to_pylist())
        return known[chunks.indices.to_numpy()], np.searchsorted(at, offsets), at


def _split_pattern(part: dict) -> str | None:
    """The pattern of the first splitting step of a pre-tokenizer."""
    if part["type"] == "Sequence":
        return next((p for p in map(_split_pattern, part["pretokenizers"]) if p), None)
    return part["pattern"]["Regex"] if part["type"] == "Split" else None


@lru_cache(maxsize=2)
def encoder(name: str, limit: int = CHUNKS) -> Encoder:
    """The process's encoder for a vocabulary file."""
    return Encoder(name, limit)
