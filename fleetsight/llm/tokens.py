"""Token ids of texts by a public byte-level BPE file, fast for whole corpora.

The pattern that splits a text before BPE never joins what stands on both sides of a single
space, or of a single newline, between two characters that aren't white space. So a text is cut
there, each distinct chunk is encoded once by the tokenizers library, and its ids are kept in a
bounded cache. Texts with any other white space are encoded whole.
"""

from __future__ import annotations

from struct import pack

import numpy as np

from fleetsight.llm.common import _BYTE_KEYS, _powers, mix64

CACHE_ENTRIES = 500_000
# a byte-level vocabulary writes visible bytes as themselves and the others from character 256 on
_HIDDEN = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b >= 174)]
_ALPHABET = {b: 256 + i for i, b in enumerate(_HIDDEN)}
_SPELLED = np.array([_ALPHABET.get(b, b) for b in range(256)], "<u4")
_IN_WORD = np.zeros(256, dtype=np.int64)  # 1 for ASCII letters and bytes of other characters, which add 2**32
_IN_WORD[65:91] = _IN_WORD[97:123] = 1
_IN_WORD[128:] = 1 + (1 << 32)
_ENCODERS: dict[str, "Encoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> "Encoder":
    """One encoder for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Encoder:
    """Ids of texts. A chunk is a space or newline with what follows it up to the next one.

    Chunks are told apart by 64-bit hashes of their bytes, so that a run of texts is cut, looked up
    and put together by whole arrays; two of the at most ``cache_entries`` chunks that are held share
    a hash with a chance of about 1 in 10^8. Only new chunks become strings.
    """

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache_entries = cache_entries
        self.stops = {c: self._encode([c])[0] for c in ".,"}
        self.line = self._encode(["\n"])[0]
        self.newline = np.frombuffer(self.line, dtype="<u4")[0]
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids whose text begins with a space
        self.opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self._hold(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def _spelled(self, text: str) -> str:
        """Text as the byte-level vocabulary writes it: a character for each byte."""
        return text.encode().decode("latin-1").translate(_ALPHABET)

    # ---- cache: sorted chunk hashes with their slots, and the slots' ids behind one another ------
    def _hold(self, keys: np.ndarray, slots: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.keys, self.slots, self.ids, self.sizes = keys, slots, ids, sizes  # a size of -1: text around this chunk can't be cut
        held = np.maximum(sizes, 0)
        self.starts = np.cumsum(held) - held
        self.again = np.zeros(len(sizes), dtype=bool)  # slots that were found again

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The slots of sorted hashes, -1 for those that aren't held."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.slots[at], -1).astype(np.int64)

    def _evict(self) -> None:
        """Keep chunks that came more than once, or none if those are too many."""
        keep = np.flatnonzero(self.again)
        if len(keep) > self.cache_entries // 2:
            keep = keep[:0]
        place = np.full(len(self.sizes), -1, np.int32)
        place[keep] = np.arange(len(keep))
        slots = place[self.slots]
        stays = slots >= 0
        self._hold(self.keys[stays], slots[stays], self.ids[_spans(self.starts[keep], np.maximum(self.sizes[keep], 0))], self.sizes[keep])

    def _learn(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Hold the chunks of sorted hashes in new slots, which follow those there are."""
        at = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, at, hashes)
        self.slots = np.insert(self.slots, at, np.arange(len(self.sizes), len(self.sizes) + len(hashes), dtype=np.int32))
        held = np.maximum(sizes, 0)
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(held) - held)
        self.ids = np.append(self.ids, ids)
        self.sizes = np.append(self.sizes, sizes)
        self.again = np.append(self.again, np.zeros(len(hashes), dtype=bool))

    def _new_chunks(self, stream: bytes, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks of the stream behind one another, and how many each has.

        Most chunks are a space and a word of letters, perhaps with a full stop or comma: those words go
        to the model in the spelling of the whole stream. The others take the general way.
        ``letters`` sums _IN_WORD over each chunk.
        """
        last = raw[ends - 1]
        stop = ((last == 46) | (last == 44)) & (ends - starts > 2)
        until = ends - stop
        plain = (raw[starts] == 32) & (letters & 0xFFFFFFFF == until - starts - 1) & (letters > 0)
        for i in np.flatnonzero(plain & (letters >> 32 > 0)).tolist():
            plain[i] = stream[starts[i] + 1 : until[i]].decode().isalpha()
        others = [stream[s:e].decode() for s, e in zip(starts[~plain].tolist(), ends[~plain].tolist(), strict=True)]
        known = self._chunk_ids(others)
        found = [known[c] for c in others]
        spelled, pieces, flat, counts = _SPELLED[raw].tobytes().decode("utf-32-le"), self.tokenizer.model.tokenize, [], []
        for s, e in zip(starts[plain].tolist(), until[plain].tolist(), strict=True):
            ids = [t.id for t in pieces(spelled[s:e])]
            flat += ids
            counts.append(len(ids))
        sizes = np.empty(len(starts), np.int64)
        sizes[plain] = counts
        sizes[plain & stop] += 1
        sizes[~plain] = [-1 if x is None else len(x) // 4 for x in found]
        held = np.maximum(sizes, 0)
        ids, kind = np.empty(int(held.sum()), np.uint32), np.repeat(plain.astype(np.int8), held)
        ids[kind == 0] = np.frombuffer(b"".join(x for x in found if x), dtype="<u4")
        for mark in ".,":
            at = (np.cumsum(held) - 1)[plain & stop & (last == ord(mark))]
            ids[at], kind[at] = np.frombuffer(self.stops[mark], dtype="<u4")[0], 2
        ids[kind == 1] = flat
        return ids, sizes

    def _chunk_ids(self, chunks: list[str]) -> dict[str, bytes | None]:
        """Encode chunks in runs; the ids that open a chunk show where each begins.

        A full stop or comma behind a letter is a piece by itself, so such a chunk is that of the
        word and one id more. A word of letters alone is one piece, which goes to the model without the pattern.
        """
        found: dict[str, bytes | None] = {}
        stopped, heads, tails = [], set(), set()
        pieces, spelled = self.tokenizer.model.tokenize, self._spelled
        for c in chunks:
            body = c[1:]
            if not body or body[0].isspace() or body[-1].isspace():
                found[c] = None
                continue
            if body[-1] in ".," and body[-2:-1].isalpha():
                stopped.append(c)
                c, body = c[:-1], body[:-1]
            if c in found:
                continue
            if body.isalpha():  # one piece of the pattern
                word = body if body.isascii() else spelled(body)
                ids = [t.id for t in pieces("\u0120" + word if c[0] == " " else word)]
                found[c] = pack(f"<{len(ids)}I", *ids) if c[0] == " " else self.line + pack(f"<{len(ids)}I", *ids)
            else:
                (heads if c[0] == "\n" else tails).add(c)
        for kind, marks in ((list(heads), lambda ids: ids == self.newline), (list(tails), lambda ids: self.opens[ids])):
            for at in range(0, len(kind), 20_000):
                run = kind[at : at + 20_000]
                ids = np.frombuffer(self._encode(["".join(run)])[0], dtype="<u4")
                edges = (4 * np.append(np.flatnonzero(marks(ids)), len(ids))).tolist()
                raw = ids.tobytes()
                found.update(zip(run, map(raw.__getitem__, map(slice, edges, edges[1:])), strict=True))
        for c in stopped:
            found[c] = found[c[:-1]] + self.stops[c[-1]]
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not texts:
            return []
        # every text is a run of lines, and every line opens with a newline
        stream = ("\n" + "\n".join(texts)).encode()
        raw = np.frombuffer(stream, dtype=np.uint8)
        starts = np.flatnonzero((raw == 32) | (raw == 10))
        sizes = np.diff(starts, append=len(raw))
        within = np.arange(len(raw)) - np.repeat(starts, sizes)
        hashes = mix64(np.add.reduceat(_BYTE_KEYS[raw] * _powers(int(sizes.max()))[within], starts))
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        slots = self._find(distinct)
        new = np.flatnonzero(slots < 0)
        if len(new) and len(self.sizes) + len(new) > self.cache_entries:
            self.again[slots[slots >= 0]] = True
            self._evict()
            slots = self._find(distinct)
            new = np.flatnonzero(slots < 0)
        self.again[slots[slots >= 0]] = True
        if len(new):
            at = first[new]
            letters = np.add.reduceat(_IN_WORD[raw], starts)[at]
            slots[new] = np.arange(len(self.sizes), len(self.sizes) + len(new))
            self._learn(distinct[new], *self._new_chunks(stream, raw, starts[at], starts[at] + sizes[at], letters))
        slot = slots[inverse]
        lengths = np.array([len(t.encode()) for t in texts])
        opening = np.searchsorted(starts, np.cumsum(lengths + 1) - lengths - 1)  # each text's first chunk
        n = self.sizes[slot]
        uncut = np.logical_or.reduceat(n < 0, opening)
        n = np.maximum(n, 0)
        flat = self.ids[_spans(self.starts[slot], n)].astype("<u4").tobytes()
        edges = (4 * np.append((np.cumsum(n) - n)[opening], n.sum())).tolist()
        # a newline is one id, and a text's first line has none
        out = [b"" if odd else flat[s + 4 : e] for s, e, odd in zip(edges[:-1], edges[1:], uncut.tolist(), strict=True)]
        whole = [i for i, odd in enumerate(uncut.tolist()) if odd or any(x in texts[i] for x in self.specials)]
        for i, ids in zip(whole, self._encode([texts[i] for i in whole]), strict=True) if whole else []:
            out[i] = ids
        return out


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all spans, behind one another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)
