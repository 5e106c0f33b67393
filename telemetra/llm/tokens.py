"""Tokenising inside tasks with the ``tokenizers`` library.

The vocabulary file is sent to the executors (``addFile``); the path is the
caller's parameter.  The public vocabularies used here are byte-level BPE whose
pre-tokeniser splits a text at white space before it merges, so a text may be cut
before every single space between two non-space characters.  A batch of texts is
cut by Arrow there, and also between an ASCII letter and a full stop or comma and
around a single line end between printable ASCII characters; each distinct piece is
encoded once, one Latin word straight by the library's BPE model, and numpy puts the
ids of the texts together.  The result equals encoding the whole text (tests compare
them); a text or piece outside these rules, and a text that holds the string of an
added token (one id to the library), is encoded whole by the library.
"""

from __future__ import annotations

import gc
import json
import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct words whose ids a worker remembers; beyond it the memory is emptied.
REMEMBERED = 500_000
_WORD = "^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+$"
#: Stands before a piece that has no space before it in the text.
_JOINED = "\x01"
_LOWER = bytes(range(256)).lower()                    # A to Z only


def _byte_chars() -> dict[int, str]:
    """Byte-level BPE's character for each byte: printable bytes stand for
    themselves, the others for 256, 257, ... in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {}, 0
    for b in range(256):
        if b in printable:
            table[b] = chr(b)
        else:
            table[b] = chr(256 + extra)
            extra += 1
    return table


def _ascii_lower(texts: pa.LargeStringArray) -> pa.Array:
    """A to Z in lower case, every other byte as it is (no nulls); of a slice only its
    own bytes are read."""
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return texts
    own = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    low = data[int(own[0]):int(own[-1])].to_pybytes().translate(_LOWER)
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer(own - own[0]), pa.py_buffer(low)])


class Encoder:
    """text -> ids as a little-endian unsigned array."""

    def __init__(self, path: str, dtype: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype(dtype or ("<u2" if size <= 1 << 16 else "<u4"))
        settings = json.loads(self.library.to_str())
        self.lower = "Lowercase" in json.dumps(settings["normalizer"])
        self.spaced = settings["normalizer"] is None
        added = [t["content"] for t in settings["added_tokens"]]
        self.added = _ascii_lower(pa.array(added, pa.large_string())).to_pylist() if self.lower else added
        self.chars = _byte_chars()
        self.words_direct = True
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        probe = [" the", "The", " Äußerst", "été", " a", "ÿÀ"]
        learnt: dict[str, bytes] = {}
        self._words(probe, learnt)
        self.words_direct = [learnt[p] for p in probe] == self._whole(probe)
        self.known: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _words(self, words: list[str], into: dict[str, bytes]) -> list[str]:
        """Add the ids of those ``words`` that are one Latin word; returns the rest."""
        asked = pa.array(words, pa.string())
        plain = pc.match_substring_regex(asked, _WORD) if self.words_direct else pa.array([False] * len(words))
        form = pc.utf8_lower(asked) if self.lower else asked
        form = pc.replace_substring(form, " ", "Ġ" if self.spaced else "")
        ascii_only = pc.string_is_ascii(asked).to_pylist()
        code, tokenize, rest = self.code, self.library.model.tokenize, []
        for p, w, ok, easy in zip(words, form.to_pylist(), plain.to_pylist(), ascii_only):
            if not ok:
                rest.append(p)
                continue
            if not easy:
                lead = self.spaced and p[0] == " "
                w = (p.lower() if self.lower else p).strip(" ").encode().decode("latin-1").translate(self.chars)
                w = "Ġ" + w if lead else w
            into[p] = array(code, [t.id for t in tokenize(w)]).tobytes()
        return rest

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """ids of each of the distinct ``pieces``."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        found = list(map(known.get, pieces))
        fresh = [i for i, ids in enumerate(found) if ids is None]
        if fresh:
            rest = self._words([pieces[i] for i in fresh], known)
            own = dict(zip(rest, self._whole(rest)))
            known.update((p, ids) for p, ids in own.items() if len(p) <= 64)
            for i in fresh:
                p = pieces[i]
                found[i] = known[p] if p in known else own[p]
        return found

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the offset of each text (and of
        the end).  A null text counts as empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(1, np.int64)
        collects = gc.isenabled()
        gc.disable()              # many small objects, no cycles among them
        try:
            return self._encode_all(texts)
        finally:
            if collects:
                gc.enable()

    def _encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        given = texts
        if self.lower:
            texts = _ascii_lower(texts)                   # "The" and "the" are one piece
        marked = pc.replace_substring_regex(texts, r"([A-Za-z])([.,])", rf"\1 {_JOINED}\2")
        marked = pc.replace_substring_regex(marked, r"([!-~])\n([!-~])", f"\\1 {_JOINED}\n {_JOINED}\\2")
        split = pc.split_pattern(marked, " ")
        bounds = np.asarray(split.offsets, dtype=np.int64)
        parts = split.values.dictionary_encode()
        codes = np.asarray(parts.indices, dtype=np.int64)
        n_words = len(parts.dictionary)
        first = bounds[:-1]                           # a text's first part has no space before it
        bare = pc.utf8_slice_codeunits(parts.dictionary, 1)
        bare = pc.if_else(pc.starts_with(parts.dictionary, _JOINED), bare, parts.dictionary)
        safe = pc.and_(pc.not_equal(bare, ""), pc.or_(
            pc.equal(parts.dictionary, _JOINED + "\n"), pc.equal(pc.utf8_trim_whitespace(bare), bare)))
        safe = safe.to_numpy(zero_copy_only=False)
        odd = np.logical_or.reduceat(~safe[codes], first)
        for mark in (_JOINED, *self.added):
            odd |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        codes[first] += n_words
        told = codes[np.repeat(~odd, np.diff(bounds))] if odd.any() else codes
        seen = np.zeros(2 * n_words, dtype=bool)
        seen[told] = True
        used = np.flatnonzero(seen)
        lead = pc.if_else(pc.starts_with(parts.dictionary, _JOINED), "", " " if self.spaced else "")
        spaced = pc.binary_join_element_wise(lead.cast(pa.large_string()), bare, pa.scalar("", pa.large_string()))
        pieces = pa.concat_arrays([spaced, parts.dictionary]).take(pa.array(used)).to_pylist()
        learnt = self._learn(pieces)
        whole = np.flatnonzero(odd)
        learnt += self._whole(given.take(pa.array(whole)).to_pylist()) if len(whole) else []
        table = np.zeros(2 * n_words, dtype=np.int64)
        table[used] = np.arange(len(used))
        # every text is a run of entries of `learnt`: its parts, or itself if odd
        runs = np.where(odd, 1, np.diff(bounds))
        ends = np.cumsum(runs)
        entries = np.empty(int(ends[-1]), dtype=np.int64)
        plain = np.repeat(~odd, runs)
        entries[plain] = table[told]
        entries[~plain] = len(used) + np.arange(len(whole))
        size = np.fromiter(map(len, learnt), np.int64, len(learnt)) // self.dtype.itemsize
        begin = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(learnt), dtype=self.dtype)
        length = size[entries]
        total = np.cumsum(length)
        pick = np.repeat(begin[entries] - (total - length), length)
        pick += np.arange(len(pick))
        return flat[pick], np.concatenate([[0], total[ends - 1]])

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def blocks(texts: pa.Array, size: int = 10_000_000):
    """Index ranges of about ``size`` bytes of text each."""
    lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(lengths.tolist()):
        total += n
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
