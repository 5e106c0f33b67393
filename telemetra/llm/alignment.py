"""Alignment of two tokenizers' tokens, and how often their tokens meet.

Two tokenizers read the same bytes, a space and the text: A a byte-level BPE file of the
tokenizers library (read with the space), B a sentencepiece model (which adds the space
itself).  Special tokens' strings are plain text to both.  Byte offsets where tokens of
both end cut the tokens into groups; a link is a pair of an A and a B token that share a
byte.  The bytes between two neighbouring ends (of either) lie in one token of each, and
two tokens share one such stretch at most, so the links are just these stretches.

Fragments.  The tokens that end in a byte range make a :class:`Fragment`: the tokens up
to the first common end (open prefix), the groups from there to the last common end
(closed, already counted and written out) and the tokens behind it (open suffix).
:func:`compose` joins neighbouring fragments: the left suffix and the right prefix make
one group, or stay open where the right has no common end.  It is associative, with
``Fragment()`` neutral, so the fragments of a long text may be composed in any tree.
Texts above ``chunk_bytes`` are dealt out as byte ranges over all tasks, each with the
bytes around it up to the next space between two printable ASCII characters (neither
tokenizer has a token across such a place, so a slice has the tokens of the whole);
:func:`_reduced` composes ``FAN`` neighbours a round until one is left.  A range
boundary inside a run without such a space that is longer than ``chunk_bytes`` is left
out, so that no byte is read by more than three ranges.  All other texts are one
fragment, closed on both sides, computed for a block of texts at once.

Corpus counts.  Each document keeps its distinct id pairs and how often it links them.
The pairs' document counts are one grouped count; they come back by broadcast joins of
about ``BROADCAST_PAIRS`` rows each, as many as the counted pairs need, so that no link
is shuffled and a pair that every document holds is no hot key.

Defined results: a text that is null or empty, or whose joined A or B bytes differ from
space and text (U+2581 in it), has no tokens: zeros and no groups; repeated rows count
as documents of their own; null ids stay null; an empty table gives an empty result;
columns other than id and text are ignored.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import default_partitions, pick, released, ship_file, ship_package, shipped_path, staged
from .tokens import Encoder, _byte_chars, blocks

#: Texts of more bytes are dealt out as ranges of so many.
CHUNK_BYTES = 1 << 16
#: Neighbouring fragments that are composed in one round.
FAN = 16
#: Rows of one broadcast table of pair counts, about.
BROADCAST_PAIRS = 1 << 20
#: Bytes of text that are aligned at once.
BLOCK_BYTES = 1 << 20
#: Distinct pieces whose ids a worker remembers; beyond it the memory is emptied.
REMEMBERED = 100_000

#: How a byte-level file splits a text into words (fixed by the format).
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces of characters that every engine's tables class alike.
_PLAIN = "^[ \n][!-~À-ÖØ-öø-ÿ]{1,64}$"

LINKS = "array<struct<a: int, b: int, n: int>>"
ALIGNED = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links {LINKS}"


# -- the two tokenizers -------------------------------------------------------------------

@dataclass
class Tokens:
    """Ids of both tokenizers, one text after the other, and each text's first id."""

    a: np.ndarray
    b: np.ndarray
    a_from: np.ndarray
    b_from: np.ndarray
    whole: np.ndarray          # both spell the space and the text

    def of(self, i: int) -> Tokens:
        """Those of one text."""
        (a, a_to), (b, b_to) = self.a_from[i:i + 2], self.b_from[i:i + 2]
        return Tokens(self.a[a:a_to], self.b[b:b_to], np.array([0, a_to - a]), np.array([0, b_to - b]), self.whole[i:i + 1])


class Pair:
    """The two tokenizers of a worker."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = Encoder(path_a)
        self.a.library.encode_special_tokens = True
        self.a.added = []
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_of = {c: b for b, c in _byte_chars().items()}
        vocab = self.a.library.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for s, i in vocab.items():
            self.bytes_a[i] = bytes(bytes_of[c] for c in s)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        # cutting before a space or a line end needs that no B token goes across
        if any(" " in t.lstrip(b" ").decode("utf-8", "replace") or (b"\n" in t and t != b"\n") for t in self.bytes_b):
            raise ValueError("a token of B goes across a space or line end")
        self.label_a, self.label_b = (pa.array(x, pa.large_binary()) for x in (self.bytes_a, self.bytes_b))
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        top = max(len(self.bytes_a), len(self.bytes_b))
        #: decimal ids, each with the four ends a token can have in the groups' text
        self.written = pa.array([f"{i}{end}" for i in range(top) for end in ("", ",", "|", ";")], pa.large_string())
        self.known: dict[str, tuple[bytes, bytes, bool]] = {}
        self.ranked = self._ranked(path_a)

    def _ranked(self, path_a: str):
        """A as ranks of its tokens' bytes, read by tiktoken: fit for pieces of plain
        letters, many in one call; None where A's file is not of that kind or a probe
        differs."""
        import tiktoken

        with open(path_a, encoding="utf-8") as f:
            settings = json.load(f)
        split, model = settings["pre_tokenizer"] or {}, settings["model"]
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if (settings["normalizer"] is not None or split.get("type") != "ByteLevel" or not split.get("use_regex")
                or split.get("add_prefix_space") or made != sorted(made) or model.get("end_of_word_suffix")):
            return None
        ranks = {t: i for i, t in enumerate(self.bytes_a) if t}
        found = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})
        probe = " the quick\nBrown été can't ÄÖ 12ab x_y (z).\n\n a"
        return found if found.encode_ordinary(probe) == self.a.library.encode(probe, add_special_tokens=False).ids else None

    def _ids_a(self, pieces: list[str]) -> dict[str, bytes]:
        """A's ids of distinct pieces."""
        out: dict[str, bytes] = {}
        rest = pieces
        if self.ranked is not None:
            plain = pc.match_substring_regex(pa.array(pieces, pa.string()), _PLAIN).to_pylist()
            told, rest = [p for p, ok in zip(pieces, plain) if ok], [p for p, ok in zip(pieces, plain) if not ok]
            flat = np.array(self.ranked.encode_ordinary("".join(told)), np.int64)
            ends = np.cumsum(np.fromiter((len(p.encode()) for p in told), np.int64, len(told)))
            cut = np.searchsorted(np.cumsum(self.length_a[flat]), ends, "right").tolist()
            packed, width = flat.astype(self.a.dtype).tobytes(), self.a.dtype.itemsize
            out = {p: packed[i * width:j * width] for p, i, j in zip(told, [0, *cut], cut)}
        out.update(zip(rest, self.a._whole(rest)))
        return out

    def _spelled(self, texts: list[str], ids_a: list[bytes], ids_b: list[list[int]]):
        """(A ids, B ids, whether both spell the text) of each text."""
        packed_b = [array("i", x).tobytes() for x in ids_b]
        data = [t.encode() for t in texts]
        flat_a = np.frombuffer(b"".join(ids_a), self.a.dtype)
        flat_b = np.frombuffer(b"".join(packed_b), np.int32)
        size_a = np.fromiter(map(len, ids_a), np.int64, len(data)) // self.a.dtype.itemsize
        size_b = np.fromiter(map(len, packed_b), np.int64, len(data)) // 4
        want, size = b"".join(data), np.fromiter(map(len, data), np.int64, len(data))
        same = np.ones(len(data), bool)
        for flat, sizes, labels in ((flat_a, size_a, self.label_a), (flat_b, size_b, self.label_b)):
            told = labels.take(pa.array(flat.astype(np.int32)))
            ends = np.asarray(told.buffers()[1]).view(np.int64)[:len(told) + 1]
            upto = ends[np.cumsum(sizes)]
            found = told.buffers()[2].to_pybytes() if told.buffers()[2] else b""
            if found[:len(want)] == want and upto[-1] == len(want) and (upto == np.cumsum(size)).all():
                continue
            begin = np.concatenate([[0], upto[:-1]])            # some text is not spelled: which
            same &= np.array([found[x:y] == d for x, y, d in zip(begin.tolist(), upto.tolist(), data)], bool)
        return list(zip(ids_a, packed_b, same.tolist()))

    def _pieces(self, pieces: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """Both tokenizers' ids of pieces that begin with a space or a line end."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [p for p in pieces if p not in self.known]
        own: dict[str, tuple[bytes, bytes, bool]] = {}
        if new:
            ids_a = self._ids_a(new)
            ids_b = self.b.encode([p[1:] if p[0] == " " else p for p in new], num_threads=1)
            ids_b = [i if p[0] == " " else i[1:] for p, i in zip(new, ids_b)]     # without the added space
            own = dict(zip(new, self._spelled(new, [ids_a[p] for p in new], ids_b)))
            self.known.update((p, x) for p, x in own.items() if len(p) <= 64)
        return [own[p] if p in own else self.known[p] for p in pieces]

    def encode(self, texts: pa.Array) -> Tokens:
        """Ids of the space and each text; pieces between safe cuts are encoded once."""
        texts = texts.cast(pa.large_string()).fill_null("")
        marked = pc.replace_substring_regex(texts, r"([!-~])\n([!-~])", "\\1 \x01\n\\2")
        split = pc.split_pattern(marked, " ")
        bounds = np.asarray(split.offsets, np.int64)
        parts = split.values.dictionary_encode()
        codes, words = np.asarray(parts.indices, np.int64), parts.dictionary
        lined = pc.starts_with(words, "\x01\n")
        bare = pc.if_else(lined, pc.utf8_slice_codeunits(words, 2), words)
        safe = pc.and_(pc.not_equal(bare, ""), pc.equal(pc.utf8_trim_whitespace(bare), bare)).to_numpy(zero_copy_only=False)
        odd = np.logical_or.reduceat(~safe[codes], bounds[:-1])
        odd |= pc.match_substring(texts, "\x01").to_numpy(zero_copy_only=False)
        inside = np.repeat(~odd, np.diff(bounds))
        used = np.unique(codes[inside])
        piece = pc.if_else(lined, pc.utf8_slice_codeunits(words, 1),
                           pc.binary_join_element_wise(pa.scalar("", words.type), words, pa.scalar(" ", words.type)))
        learnt = self._pieces(piece.take(pa.array(used)).to_pylist())
        alone = np.flatnonzero(odd)
        whole = texts.take(pa.array(alone)).to_pylist()
        spaced = [" " + t for t in whole]
        if whole:
            learnt += self._spelled(spaced, self.a._whole(spaced), self.b.encode(whole, num_threads=1))
        table = np.zeros(len(words), np.int64)
        table[used] = np.arange(len(used))
        runs = np.where(odd, 1, np.diff(bounds))
        ends = np.cumsum(runs)
        entry = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        plain = np.repeat(~odd, runs)
        entry[plain] = table[codes[inside]]
        entry[~plain] = len(used) + np.arange(len(alone))
        same = np.fromiter((x[2] for x in learnt), bool, len(learnt))
        fine = np.logical_and.reduceat(same[entry], ends - runs) & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
        # texts without tokens keep none
        keep = np.repeat(fine, runs)
        a, a_from = _gathered([x[0] for x in learnt], self.a.dtype, entry, keep, ends)
        b, b_from = _gathered([x[1] for x in learnt], np.dtype("<i4"), entry, keep, ends)
        return Tokens(a, b, a_from, b_from, fine)


def _gathered(entries: list[bytes], dtype: np.dtype, entry: np.ndarray, keep: np.ndarray, ends: np.ndarray):
    """The ids of the entries that make up the texts, and where each text's begin."""
    size = np.fromiter(map(len, entries), np.int64, len(entries)) // dtype.itemsize
    begin = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(entries), dtype=dtype).astype(np.int64)
    length = np.where(keep, size[entry], 0)
    total = np.cumsum(length)
    at = np.repeat(begin[entry] - (total - length), length) + np.arange(int(total[-1]) if len(total) else 0)
    return flat[at], np.concatenate([[0], total[ends - 1]]).astype(np.int64)


# -- groups and links ---------------------------------------------------------------------

@dataclass
class Open:
    """Tokens of both sides that lie in a group not closed yet, with their ends."""

    a: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    a_end: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    b: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    b_end: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __add__(self, other: Open) -> Open:
        return Open(*(np.concatenate([x, y]) for x, y in zip(self.parts(), other.parts())))

    def parts(self):
        return self.a, self.a_end, self.b, self.b_end


@dataclass
class Closed:
    """Whole groups: their text, counts and distinct links (a * 2**32 + b, times)."""

    groups: str = ""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    pair: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __add__(self, other: Closed) -> Closed:
        pair, at = np.unique(np.concatenate([self.pair, other.pair]), return_inverse=True)
        times = np.bincount(at, np.concatenate([self.times, other.times]), len(pair)).astype(np.int64)
        return Closed(";".join(x for x in (self.groups, other.groups) if x), self.n_a + other.n_a, self.n_b + other.n_b,
                      self.n_groups + other.n_groups, self.n_links + other.n_links, pair, times)


@dataclass
class Fragment:
    """Open prefix, closed groups, open suffix; ``cut`` tells whether both tokenizers
    end a token somewhere in it (else all its tokens are prefix)."""

    prefix: Open = field(default_factory=Open)
    body: Closed = field(default_factory=Closed)
    suffix: Open = field(default_factory=Open)
    cut: bool = False
    whole: bool = True


def compose(pair: Pair, left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring byte ranges."""
    whole = left.whole and right.whole
    if not whole:                                  # the document has no tokens at all
        return Fragment(whole=False)
    if not right.cut:
        if left.cut:
            return Fragment(left.prefix, left.body, left.suffix + right.prefix, True)
        return Fragment(left.prefix + right.prefix)
    if not left.cut:
        return Fragment(left.prefix + right.prefix, right.body, right.suffix, True)
    met = closed(pair, left.suffix + right.prefix)
    return Fragment(left.prefix, left.body + met + right.body, right.suffix, True)


def closed(pair: Pair, tokens: Open) -> Closed:
    """The groups of tokens that begin and end at common ends."""
    if not len(tokens.a):
        return Closed()
    rows = grouped(pair, *tokens.parts(), np.array([tokens.a_end[-1]]))
    return Closed(rows.groups[0].as_py(), len(tokens.a), len(tokens.b), int(rows.n_groups[0]), int(rows.n_links[0]),
                  rows.pair, rows.times)


@dataclass
class Grouped:
    """Groups and links of several texts, all at once."""

    groups: pa.Array
    n_groups: np.ndarray
    n_links: np.ndarray
    text: np.ndarray           # of each distinct link
    pair: np.ndarray
    times: np.ndarray


def _merged(a_end: np.ndarray, b_end: np.ndarray):
    """The distinct ends of both sides in order, with the ends of A and of B up to and
    including each."""
    ends = np.concatenate([a_end, b_end])
    order = np.argsort(ends, kind="stable")          # two sorted runs: one merge
    ends, of_a = ends[order], order < len(a_end)
    keep = np.append(ends[1:] != ends[:-1], True) if len(ends) else np.zeros(0, bool)
    upto_a = np.cumsum(of_a)
    return ends[keep], upto_a[keep], (np.arange(1, len(ends) + 1) - upto_a)[keep]


def grouped(pair: Pair, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, text_end: np.ndarray) -> Grouped:
    """Align the tokens of texts that lie one after the other; ``text_end`` are the ends
    of the texts (each a common end; texts without tokens repeat the one before)."""
    stretch, upto_a, upto_b = _merged(a_end, b_end)
    from_a, from_b = np.concatenate([[0], upto_a[:-1]]), np.concatenate([[0], upto_b[:-1]])
    from_a, from_b = from_a[:len(stretch)], from_b[:len(stretch)]
    ends_a, ends_b = upto_a > from_a, upto_b > from_b
    common = ends_a & ends_b
    before = np.cumsum(common) - common                 # common ends before each end
    # links: the stretches between neighbouring ends
    upto = np.searchsorted(stretch, text_end, "right")
    n_links = np.diff(upto, prepend=0)
    n_groups = np.diff(np.concatenate([[0], np.cumsum(common)])[upto], prepend=0)
    top = np.int64(len(pair.bytes_b))
    every = len(pair.bytes_a) * top
    key = np.sort(np.repeat(np.arange(len(text_end)), n_links) * every + a[from_a] * top + b[from_b])
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(key)))
    text, linked = key[first] // every, key[first] % every
    # text: the tokens of a group, A before B, each with what stands behind it
    group_a, group_b = before[ends_a], before[ends_b]
    at_a = np.arange(len(a)) + np.concatenate([[0], upto_b[common]])[group_a]
    at_b = np.arange(len(b)) + upto_a[common][group_b]
    behind_a = np.where(np.diff(group_a, append=-1) != 0, 2, 1)
    last = np.zeros(int(common.sum()), bool)
    last[np.cumsum(n_groups)[n_groups > 0] - 1] = True
    behind_b = np.where(np.diff(group_b, append=-1) != 0, np.where(last[group_b], 0, 3), 1)
    written = np.empty(len(a) + len(b), np.int64)
    written[at_a], written[at_b] = a * 4 + behind_a, b * 4 + behind_b
    tokens = np.concatenate([[0], upto_a + upto_b])[upto]
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], tokens])), pair.written.take(pa.array(written)))
    return Grouped(pc.binary_join(lists, pa.scalar("", pa.large_string())), n_groups, n_links,
                   text, (linked // top) << 32 | linked % top, times)


def fragment(pair: Pair, tokens: Tokens, base: int, after: int, upto: int) -> Fragment:
    """The fragment of the range (after, upto] from the tokens of one slice, which
    begins at byte ``base``."""
    if not tokens.whole[0]:
        return Fragment(whole=False)
    a_end, b_end = base + np.cumsum(pair.length_a[tokens.a]), base + np.cumsum(pair.length_b[tokens.b])
    own_a, own_b = (a_end > after) & (a_end <= upto), (b_end > after) & (b_end <= upto)
    mine = Open(tokens.a[own_a], a_end[own_a], tokens.b[own_b], b_end[own_b])
    common = np.intersect1d(mine.a_end, mine.b_end, assume_unique=True)
    if not len(common):
        return Fragment(mine)

    def between(low, high):
        x, y = (mine.a_end > low) & (mine.a_end <= high), (mine.b_end > low) & (mine.b_end <= high)
        return Open(mine.a[x], mine.a_end[x], mine.b[y], mine.b_end[y])

    first, last = int(common[0]), int(common[-1])
    return Fragment(between(-1, first), closed(pair, between(first, last)), between(last, 1 << 62), True)


def ranges(text: bytes, chunk_bytes: int) -> list[tuple[int, int, int, int]]:
    """(after, upto, slice begin, slice end) of each byte range of the space and text."""
    data = np.frombuffer(b" " + text, np.uint8)
    printed = (data >= 33) & (data <= 126)
    cut = np.flatnonzero((data[1:-1] == 32) & printed[:-2] & printed[2:]) + 1
    cut = np.concatenate([[0], cut, [len(data)]])
    wanted = np.arange(chunk_bytes, len(data), chunk_bytes)
    low = cut[np.searchsorted(cut, wanted, "right") - 1]
    high = cut[np.searchsorted(cut, wanted, "left")]
    fine = high - low <= chunk_bytes
    edge = np.concatenate([[0], wanted[fine], [len(data)]])
    begin = np.concatenate([[0], low[fine]])
    end = np.concatenate([high[fine], [len(data)]])
    return [tuple(map(int, x)) for x in zip(edge[:-1], edge[1:], begin, end)]


# -- Spark --------------------------------------------------------------------------------

_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(path_a: str, path_b: str) -> Pair:
    """One pair of tokenizers per worker process and files."""
    if (path_a, path_b) not in _PAIRS:
        _PAIRS[path_a, path_b] = Pair(path_a, path_b)
    return _PAIRS[path_a, path_b]


_LINK = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())]))


def _links(upto: np.ndarray, pair: np.ndarray, times: np.ndarray) -> pa.Array:
    values = pa.StructArray.from_arrays([pa.array((pair >> 32).astype(np.int32)), pa.array((pair & 0xFFFFFFFF).astype(np.int32)),
                                         pa.array(times.astype(np.int32))], fields=list(_LINK.value_type))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], upto]).astype(np.int32)), values, type=_LINK)


def _aligned(pair: Pair, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """One row per text."""
    t = pair.encode(texts)
    a_end, b_end = np.cumsum(pair.length_a[t.a]), np.cumsum(pair.length_b[t.b])
    text_end = np.concatenate([[0], a_end])[t.a_from[1:]]
    found = grouped(pair, t.a, a_end, t.b, b_end, text_end)
    upto = np.searchsorted(found.text, np.arange(len(ids)), "right")
    return pa.RecordBatch.from_arrays(
        [ids, *(pa.array(np.asarray(x, np.int64)) for x in (np.diff(t.a_from), np.diff(t.b_from), found.n_groups, found.n_links)),
         found.groups.cast(pa.string()), _links(upto, found.pair, found.times)],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])


_OPEN = ("a", "a_end", "b", "b_end")
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
FRAGMENT = ("key long, doc_id long, no long, " + ", ".join(f"{side}_{x} array<long>" for side in ("prefix", "suffix") for x in _OPEN)
            + ", " + ", ".join(f"{x} long" for x in _COUNTS) + ", groups string, pair array<long>, times array<long>, cut boolean, whole boolean")


def _to_row(key: int, ident: int | None, no: int, f: Fragment) -> dict:
    row = {"key": key, "doc_id": ident, "no": no, "cut": f.cut, "whole": f.whole, "groups": f.body.groups,
           "pair": f.body.pair, "times": f.body.times} | {x: getattr(f.body, x) for x in _COUNTS}
    for side, tokens in (("prefix", f.prefix), ("suffix", f.suffix)):
        row |= {f"{side}_{x}": v for x, v in zip(_OPEN, tokens.parts())}
    return row


def _from_row(row: dict) -> Fragment:
    def numbers(name):
        return np.array(row[name], np.int64)

    prefix, suffix = (Open(*(numbers(f"{side}_{x}") for x in _OPEN)) for side in ("prefix", "suffix"))
    body = Closed(row["groups"], *(row[x] for x in _COUNTS), numbers("pair"), numbers("times"))
    return Fragment(prefix, body, suffix, row["cut"], row["whole"])


def _fragment_batch(rows: list[dict]) -> pa.Table:
    lists = pa.list_(pa.int64())
    kinds = {"groups": pa.string(), "pair": lists, "times": lists, "cut": pa.bool_(), "whole": pa.bool_()}
    kinds |= {f"{side}_{x}": lists for side in ("prefix", "suffix") for x in _OPEN}
    names = [c.split()[0] for c in FRAGMENT.split(", ")]
    return pa.table([pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names], names=names)


def _chunks(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    """Slices of long texts, one row per byte range, dealt out over all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, ident, text in zip(*(batch.column(i) for i in range(3))):
                data, ident = text.as_py().encode(), ident.as_py()
                parts = ranges(data, chunk_bytes)
                for i in range(0, len(parts), 64):
                    own = parts[i:i + 64]
                    after, upto, begin, end = (pa.array(x, pa.int64()) for x in zip(*own))
                    # a slice begins with the space that is not part of its text
                    texts = pa.array([data[lo:hi - 1] for _, _, lo, hi in own], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()] * len(own), pa.int64()), pa.array([ident] * len(own), pa.int64()),
                         pa.array(range(i, i + len(own)), pa.int64()), after, upto, begin, texts],
                        names=["key", "doc_id", "no", "after", "upto", "base", "text"])

    cut = rows.withColumn("key", F.monotonically_increasing_id()).select("key", "doc_id", "text").mapInArrow(
        lambda b: released(run(b)), "key long, doc_id long, no long, after long, upto long, base long, text string")
    return cut.repartition(default_partitions(rows.sparkSession), "key", "no")


def _fragments(chunks: DataFrame, get_pair) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = get_pair()
        for batch in batches:
            texts, rows = batch.column("text"), batch.drop_columns(["text"])
            for a, b in blocks(texts, BLOCK_BYTES):
                tokens = pair.encode(texts.slice(a, b - a))
                yield from _fragment_batch([
                    _to_row(r["key"], r["doc_id"], r["no"], fragment(pair, tokens.of(i), r["base"], r["after"], r["upto"]))
                    for i, r in enumerate(rows.slice(a, b - a).to_pylist())]).to_batches()

    return chunks.mapInArrow(lambda b: released(run(b)), FRAGMENT)


def _reduced(fragments: DataFrame, most: int, get_pair) -> DataFrame:
    """One fragment per key: ``FAN`` neighbours are composed a round."""
    def run(table: pa.Table) -> pa.Table:
        pair = get_pair()
        rows = sorted(table.to_pylist(), key=lambda r: r["no"])
        found = reduce(lambda x, y: compose(pair, x, y), map(_from_row, rows))
        return _fragment_batch([_to_row(rows[0]["key"], rows[0]["doc_id"], rows[0]["no"] // FAN, found)])

    while most > 1:
        fragments = fragments.groupBy("key", F.expr(f"no div {FAN}").alias("at")).applyInArrow(run, FRAGMENT)
        most = -(-most // FAN)
    return fragments


def _finished(fragments: DataFrame, get_pair) -> DataFrame:
    """Rows of :data:`ALIGNED`: the text's begin is a common end, and so is its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = get_pair()
        for batch in batches:
            for r in batch.to_pylist():
                whole = compose(pair, Fragment(cut=True), _from_row(r))
                body = whole.body if whole.whole else Closed()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["doc_id"]], pa.int64()), *(pa.array([getattr(body, x)], pa.int64()) for x in _COUNTS),
                     pa.array([body.groups], pa.string()), _links(np.array([len(body.pair)]), body.pair, body.times)],
                    names=["doc_id", *_COUNTS, "groups", "links"])

    return fragments.mapInArrow(lambda b: released(run(b)), ALIGNED)


def aligned(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, id_col: str = "doc_id", text_col: str = "text",
            chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``) and links
    (the distinct id pairs and how often each is linked) of every document."""
    spark = docs.sparkSession
    ship_package(spark)
    name_a, name_b = ship_file(spark, vocabulary_a), ship_file(spark, vocabulary_b)

    def get_pair():
        return pair_of(shipped_path(name_a), shipped_path(name_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = get_pair()
        for batch in batches:
            texts = batch.column(1)
            for a, b in blocks(texts, BLOCK_BYTES):
                yield _aligned(pair, batch.column(0).slice(a, b - a), texts.slice(a, b - a))

    rows = docs.select(pick(id_col).cast("long").alias("doc_id"), pick(text_col).cast("string").alias("text"))
    long = F.coalesce(F.octet_length("text") > chunk_bytes, F.lit(False))
    out = rows.where(~long).mapInArrow(lambda b: released(run(b)), ALIGNED)
    longest = rows.agg(F.max(F.octet_length("text"))).first()[0] or 0
    if longest > chunk_bytes:
        made = _fragments(_chunks(rows.where(long), chunk_bytes), get_pair)
        out = out.unionByName(_finished(_reduced(made, -(-(longest + 1) // chunk_bytes), get_pair), get_pair))
    return out


def pair_counts(links: DataFrame) -> DataFrame:
    """a, b, docs (documents that hold the pair linked) and best (docs is the highest of
    all pairs of ``a``)."""
    counts = links.select(F.inline("links")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"))
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))


def with_counts(rows: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``rows`` (a written table of :data:`ALIGNED` columns with a unique ``key``) with
    n_best and count_sum instead of links: the links whose count is their A id's highest,
    and the counts summed over all links."""
    counts = staged(pair_counts(rows))
    n_blocks = -(-counts.count() // broadcast_pairs) or 1
    linked = rows.select("key", F.inline("links"))

    def block(df: DataFrame, k: int) -> DataFrame:
        return df if n_blocks == 1 else df.where(F.pmod(F.xxhash64("a", "b"), F.lit(n_blocks)) == k)

    parts = [block(linked, k).join(F.broadcast(block(counts, k)), ["a", "b"]).groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("docs")).alias("count_sum")) for k in range(n_blocks)]
    sums = reduce(DataFrame.unionByName, parts)
    if n_blocks > 1:
        sums = sums.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.drop("links").join(sums, "key", "left").withColumns(
        {"n_best": F.coalesce("n_best", zero), "count_sum": F.coalesce("count_sum", zero)}).drop("key")


def align(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, id_col: str = "doc_id", text_col: str = "text",
          chunk_bytes: int = CHUNK_BYTES, digest: bool = False) -> DataFrame:
    """:func:`aligned` with n_best and count_sum of the whole corpus instead of links;
    with ``digest`` groups_sha256 (``''`` without tokens) instead of groups, so that the
    groups' text is written nowhere."""
    rows = aligned(docs, vocabulary_a, vocabulary_b, id_col, text_col, chunk_bytes)
    if digest:
        rows = rows.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
    return with_counts(staged(rows.withColumn("key", F.monotonically_increasing_id())))
