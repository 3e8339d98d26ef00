"""Token ids by a public tokenizer, inside tasks."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_TEXT_AT_ONCE = 4 << 20  # characters whose words are looked up together
_WORDS_AT_ONCE = 512  # new words encoded in one call
_CACHED_BYTES = 120 << 20  # of words and their ids in each of two generations of the cache, with what Python adds
_IDLE_SECONDS = 5.0  # after which a worker that encodes nothing drops its cache
_ENTRY = 220  # bytes that a cached word takes beside its letters and ids
# Of the bytes: 1 for letters of ASCII, 2 for its digits and signs. An apostrophe may be part of a contraction and is neither.
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 2
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[0x27] = 0
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
# Letters of Latin-1 are 0xC3 and one of these in UTF-8; the upper ones become lower by the same bit as in ASCII.
_LATIN = np.zeros(256, bool)
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
_BEYOND = 0xC4  # the first byte of characters beyond Latin-1, among them all that combine with a letter before them

_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of whole texts, put together from those of their words.

    Holds for tokenizers that never join or look across white space, as those that drop it
    do: a text's ids are then the ids of its white-space-free parts in order, whatever
    stands around them. New parts are encoded by the library, many in one call; the ids of
    those met before are kept, within a fixed bound, for as long as the worker has work.
    Spark leaves idle workers alive beside those of the next stages, so one that has encoded
    nothing for some seconds drops what it kept.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        spec = json.loads(self.tokenizer.to_str())
        # Where case is dropped, and letters are always apart from digits and punctuation, texts
        # can be in lower case and cut there, but for words with a token that is looked for as it stands.
        steps, apart = json.dumps(spec["normalizer"]), json.dumps(spec["pre_tokenizer"])
        self.plain = '"Lowercase"' in steps and "|[\\\\p{L}]+|" in apart and "|[^\\\\s\\\\p{L}\\\\p{N}]+" in apart
        self.plain &= all(t["content"].isascii() and not t["normalized"] for t in spec["added_tokens"])
        self.verbatim = [t["content"].encode().lower() for t in spec["added_tokens"]]
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.size = 0
        self.lock = threading.Lock()
        self.running = 0  # calls of encode that have not ended
        self.idle: threading.Timer | None = None

    @staticmethod
    def of(path: str) -> "WordEncoder":
        if path not in _encoders:
            _encoders[path] = WordEncoder(path)
        return _encoders[path]

    def _keep(self, word: bytes, ids: bytes) -> bytes:
        self.new[word] = ids
        self.size += _ENTRY + len(word) + len(ids)
        return ids

    def _missing(self, words: Iterable[bytes]) -> list[bytes]:
        """Those of ``words`` that no generation has; what the older one has is kept on."""
        missing, old, new, size = [], self.old.get, self.new, 0
        for w in words:
            ids = old(w)
            if ids is None:
                missing.append(w)
            else:
                new[w] = ids
                size += _ENTRY + len(w) + len(ids)
        self.size += size
        return missing

    def _encode_new(self, words: list[bytes]) -> None:
        for i in range(0, len(words), _WORDS_AT_ONCE):
            block = words[i : i + _WORDS_AT_ONCE]
            texts = [w.decode() for w in block]
            starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
            encoding = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = np.array(encoding.ids, self.dtype).tobytes()
            at = np.array([s for s, _ in encoding.offsets], np.int64)
            cuts = (np.searchsorted(at, starts) * self.dtype.itemsize).tolist()
            for w, lo, hi in zip(block, cuts, [*cuts[1:], len(ids)]):
                self._keep(w, ids[lo:hi])

    def _cut(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts, one after the other, in lower case and with a space between letters and digits or signs.

        Only letters of ASCII and Latin-1 are touched, and none that a combining mark may follow.
        """
        after = np.append(data[1:], np.uint8(0))
        kind, low = _KIND[data], data.copy()
        latin = np.flatnonzero(data == 0xC3)
        latin = latin[_LATIN[after[latin]]]
        kind[latin] = kind[latin + 1] = 1
        upper = (data >= 0x41) & (data <= 0x5A)
        upper[latin[after[latin] < 0x9F] + 1] = True
        low |= (upper & (after < _BEYOND)).view(np.uint8) << np.uint8(5)
        raw, bounds = data.tobytes().lower(), None
        for token in self.verbatim:
            at = raw.find(token)
            while at >= 0:  # the word around it is left as it is
                bounds = np.union1d(np.flatnonzero(_WHITE[data]), starts) if bounds is None else bounds
                after_it = np.searchsorted(bounds, at, "right")
                own = slice(bounds[after_it - 1], bounds[after_it])
                low[own], kind[own] = data[own], 0
                at = raw.find(token, own.stop)
        cuts = np.flatnonzero((kind[1:] ^ kind[:-1]) == 3) + 1
        return np.insert(low, cuts, 0x20), starts + np.searchsorted(cuts, starts)

    def _lookup(self, texts: list[bytes]) -> Iterator[bytes]:
        data, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        if self.plain and len(data):
            data, starts = self._cut(data, starts)
        parts = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(starts), pa.py_buffer(data)]))
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        self.new[b""] = b""
        self._encode_new(self._missing(filterfalse(self.new.__contains__, words)))
        ids = pa.array(list(map(self.new.__getitem__, words)), pa.large_binary()).take(coded.indices)
        # The ids of all words lie one after the other; a text's are those from its first word to the next text's.
        starts = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[parts.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        data = ids.buffers()[2]
        yield from [data[lo:hi].to_pybytes() if hi > lo else b"" for lo, hi in zip(starts, starts[1:])]
        if self.size > _CACHED_BYTES:
            self.old, self.new, self.size = self.new, {}, 0

    def _begin(self) -> None:
        with self.lock:
            self.running += 1
            if self.idle is not None:
                self.idle.cancel()
                self.idle = None

    def _end(self) -> None:
        with self.lock:
            self.running -= 1
            if not self.running:
                self.idle = threading.Timer(_IDLE_SECONDS, self._forget)
                self.idle.daemon = True
                self.idle.start()

    def _forget(self) -> None:
        with self.lock:
            if self.running or self.idle is not threading.current_thread():
                return  # work came meanwhile
            self.old, self.new, self.size, self.idle = {}, {}, 0, None
        pa.default_memory_pool().release_unused()

    def encode(self, texts: Iterable[bytes | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian numbers of ``dtype``; a null text has none."""
        self._begin()
        try:
            batch, size = [], 0
            for text in texts:
                batch.append(text or b"")
                size += len(batch[-1])
                if size >= _TEXT_AT_ONCE:
                    yield from self._lookup(batch)
                    batch, size = [], 0
            if batch:
                yield from self._lookup(batch)
        finally:
            self._end()
