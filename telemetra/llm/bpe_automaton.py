"""Byte-pair encoding by a tokenisation automaton.

The automaton reads tokens: a sequence of tokens is accepted exactly if it is what the
merges make of its bytes.  It begins as one state that loops on every base symbol and is
changed by one gadget per merge (a, b), in the order of the merges: let q be the state
that ``a`` leads to; if q has an arc ``b``, then ``a`` leads from now on to a copy q' of
q without the arc ``b`` (the pair can stand no longer), and every state with an arc
``a`` gets an arc ``ab`` to the state that ``b`` leads to.  All arcs of one token lead
to one state, so the automaton is deterministic at every step.

It is kept as a table.  Written out, most of its arcs would be copies; a copy q' differs
from q by one arc, so only that arc is stored: ``gadget[a, b]`` is the merge that
removed ``b`` behind ``a``.  All others are inherited: an arc ``ab`` stands where the
arc ``a`` stood when the merge was compiled, and the state behind ``ab`` is the one
behind ``b`` at that time.  Following these two rules back from (state, token) takes as
many steps as the two tokens have nested parts (:meth:`Automaton.allows`).

Encoding.  A pre-split word is read byte by byte.  Exactly one path of the automaton
spells each prefix of a word, so at every position stands one token, the last of that
path; from there the trie of the tokens names the candidates further on, and the table
tells which arc exists.  Words of like length go through numpy together.

Decoding.  The automaton's arcs carry labels, the tokens' strings; the labels of the ids
are put out in order, joined by one space where the vocabulary file names no decoder,
as the library does, or turned back into bytes where its decoder is byte-level.

Normalising and pre-splitting follow the vocabulary file (the library's normalizer and
pre-tokenizer objects); no word is encoded by the library.

Defined results: a null text counts as empty and has no ids; rows are encoded each by
itself, repeated ones too; null ids stay null; an empty table gives an empty result;
columns other than id and text are ignored; a vocabulary of another kind than BPE over
bytes raises ValueError.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import pick, released, ship_file, ship_package, shipped_path
from .tokens import _WORD, Encoder, _byte_chars, blocks

NEVER = np.int64(1) << 40
#: Words of at most so many bytes are read together by position.
TOGETHER = 48
#: Fewer words than this are read one by one.
FEW_WORDS = 16


class PairTable:
    """A fixed map (x, y) -> value by open addressing, looked up in bulk."""

    def __init__(self, pairs: dict[tuple[int, int], int], width: int):
        self.width = width
        bits = max(4, (len(pairs) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int64)
        if not pairs:
            return
        key = np.array([x * width + y for x, y in pairs], np.int64)
        value = np.array(list(pairs.values()), np.int64)
        left, slot = np.arange(len(key)), self._slot(key)
        while len(left):                       # one key takes a free slot, the others move on
            free = self.keys[slot] < 0
            self.keys[slot[free]] = key[left[free]]
            took = self.keys[slot] == key[left]
            self.values[slot[took]] = value[left[took]]
            left, slot = left[~took], (slot[~took] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Values, -1 where the pair is absent."""
        key = x * self.width + y
        slot = self._slot(key)
        met = self.keys[slot]
        out = np.where(met == key, self.values[slot], -1)
        open_ = np.flatnonzero((met != key) & (met >= 0))
        while len(open_):
            slot_ = slot[open_] = (slot[open_] + 1) & self.mask
            met = self.keys[slot_]
            hit = met == key[open_]
            out[open_[hit]] = self.values[slot_[hit]]
            open_ = open_[~hit & (met >= 0)]
        return out


class Automaton:
    """The compiled merges of one vocabulary file (its ``model`` part)."""

    def __init__(self, model: dict):
        if model.get("type") != "BPE" or model.get("dropout") or model.get("byte_fallback") \
                or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("not a plain BPE vocabulary")
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        self.left, self.right = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        self.born = np.full(self.size, -1, np.int64)            # the merge that made the token
        self._compile([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], vocab.values())
        chars = _byte_chars()
        #: base symbol of each byte inside a word, then of each byte at its end
        self.base = np.array([vocab.get(chars[b], -1) for b in range(256)]
                             + [vocab.get(chars[b] + suffix, -1) for b in range(256)], np.int64)
        if (self.base < 0).any():
            raise ValueError("the vocabulary lacks a byte")
        self._trie()

    # -- compiling ------------------------------------------------------------------

    def _compile(self, merges: list[tuple[int, int, int]], vocab: Iterable[int]) -> None:
        left, right, born = ([-1] * self.size for _ in range(3))
        gadget: dict[tuple[int, int], int] = {}
        made = set(vocab) - {ab for _, _, ab in merges}
        for step, (a, b, ab) in enumerate(merges):
            # the arc b behind a exists still; a token is made once, of tokens that are made
            if ab in made or a not in made or b not in made or not _stands(gadget, left, right, born, a, b, step):
                continue
            made.add(ab)
            gadget[a, b] = step
            left[ab], right[ab], born[ab] = a, b, step
        self._gadget, self._l, self._r, self._b = gadget, left, right, born
        self.left, self.right, self.born = (np.array(x, np.int64) for x in (left, right, born))
        self.gadget = PairTable(gadget, self.size)

    def _trie(self) -> None:
        """Tokens spelled in base symbols: edges (node, symbol) -> node, and the token
        at a node.  A token that no arc carries (never made) has no node."""
        symbol = {int(t): i for i, t in reversed(list(enumerate(self.base.tolist())))}
        self.symbol = np.array([symbol[int(t)] for t in self.base], np.int64)
        spelled: dict[int, tuple[int, ...]] = {t: (s,) for t, s in symbol.items()}
        for t in np.argsort(self.born, kind="stable").tolist():
            if self._b[t] >= 0:
                spelled[t] = spelled[self._l[t]] + spelled[self._r[t]]
        edges: dict[tuple[int, int], int] = {}
        token = [-1]
        for t, own in spelled.items():
            node = 0
            for s in own:
                if (node, s) not in edges:
                    edges[node, s] = len(token)
                    token.append(-1)
                node = edges[node, s]
            token[node] = t
        self._edges, self._token = edges, token
        self.edges, self.token = PairTable(edges, 512), np.array(token, np.int64)

    # -- arcs -------------------------------------------------------------------------

    def allows(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether the state behind token ``before`` has an arc ``after``."""
        out = np.ones(len(before), bool)
        who, r, u = np.arange(len(before)), before.copy(), after.copy()
        until = np.full(len(before), NEVER)       # gadgets from here on do not count
        while len(who):
            gone = self.gadget.get(r, u)
            removed = (gone >= 0) & (gone < until)
            out[who[removed]] = False
            br, bu = self.born[r], self.born[u]
            on = ~removed & ((br >= 0) | (bu >= 0))
            who, r, u, br, bu = who[on], r[on], u[on], br[on], bu[on]
            newer = bu > br                          # the arc u was added after the state's last copy
            until = np.where(newer, np.minimum(until[on], bu + 1), br)
            r, u = np.where(newer, r, self.right[r]), np.where(newer, self.left[u], u)
        return out

    # -- encoding ---------------------------------------------------------------------

    def encode_word(self, word: bytes) -> list[int]:
        """The path that spells one word."""
        n = len(word)
        symbols = self.symbol[np.frombuffer(word, np.uint8).astype(np.int64)].tolist()
        if n:
            symbols[-1] = int(self.symbol[256 + word[-1]])
        last, back = [-1] * (n + 1), [0] * (n + 1)
        edges, token = self._edges, self._token
        for i in range(n):
            node, before = 0, last[i]
            if i and before < 0:
                raise ValueError("no path spells the word")
            for j in range(i, n):
                node = edges.get((node, symbols[j]), -1)
                if node < 0:
                    break
                t = token[node]
                if t >= 0 and last[j + 1] < 0 and (
                        before < 0 or _stands(self._gadget, self._l, self._r, self._b, before, t, int(NEVER))):
                    last[j + 1], back[j + 1] = t, i
        out = []
        while n:
            out.append(last[n])
            n = back[n]
        return out[::-1]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        out: list[list[int]] = [[]] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        short = np.flatnonzero((size > 0) & (size <= TOGETHER))
        if len(short) < FEW_WORDS:
            short = short[:0]
        alone = np.flatnonzero(size > 0)
        for i in np.setdiff1d(alone, short).tolist():
            out[i] = self.encode_word(words[i])
        short = short[np.argsort(-size[short], kind="stable")]      # longest first
        for a in range(0, len(short), 1 << 15):
            own = short[a:a + (1 << 15)]
            for i, ids in zip(own.tolist(), self._together([words[i] for i in own.tolist()], size[own])):
                out[i] = ids
        return out

    def _together(self, words: list[bytes], size: np.ndarray) -> list[list[int]]:
        """Words of falling length, all at one position after the other."""
        k, n = len(words), int(size[0])
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begin = np.cumsum(size) - size
        flat[begin + size - 1] += 256                               # the end of a word
        flat = self.symbol[flat]
        last, back = np.full((n + 1, k), -1, np.int64), np.zeros((n + 1, k), np.int64)
        alive = np.searchsorted(-size, -np.arange(n), "left")       # words longer than i
        for i in range(n):
            who = np.arange(alive[i])
            node = np.zeros(len(who), np.int64)
            for j in range(i, n):
                on = size[who] > j
                who, node = who[on], node[on]
                if not len(who):
                    break
                node = self.edges.get(node, flat[begin[who] + j])
                on = node >= 0
                who, node = who[on], node[on]
                if not len(who):
                    break
                t = self.token[node]
                asked = np.flatnonzero((t >= 0) & (last[j + 1, who] < 0))
                if i:
                    asked = asked[self.allows(last[i, who[asked]], t[asked])]
                last[j + 1, who[asked]] = t[asked]
                back[j + 1, who[asked]] = i
        at, here = size.copy(), np.arange(k)
        turned: list[list[int]] = [[] for _ in range(k)]
        while len(here):
            ids = last[at[here], here]
            if (ids < 0).any():
                raise ValueError("no path spells the word")
            for w, t in zip(here.tolist(), ids.tolist()):
                turned[w].append(t)
            at[here] = back[at[here], here]
            here = here[at[here] > 0]
        return [x[::-1] for x in turned]


def _stands(gadget, left, right, born, r: int, u: int, until: int) -> bool:
    """:meth:`Automaton.allows` for one pair, while the gadgets before ``until`` count."""
    while True:
        gone = gadget.get((r, u), -1)
        if 0 <= gone < until:
            return False
        br, bu = born[r], born[u]
        if br < 0 and bu < 0:
            return True
        if bu > br:
            u, until = left[u], min(until, bu + 1)
        else:
            r, until = right[r], br


class AutomatonEncoder(Encoder):
    """Texts to ids through the automaton: the helper's cutting into pieces that are
    encoded once each, with the words of the pieces read by the automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        self.automaton = Automaton(settings["model"])
        self.specials = {t["content"]: t["id"] for t in settings["added_tokens"]}
        longest = sorted(self.specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.byte_of = {ord(c): b for b, c in _byte_chars().items()}
        super().__init__(path)

    def _words(self, words: list[str], into: dict[str, bytes]) -> list[str]:
        asked = pa.array(words, pa.string())
        plain = pc.match_substring_regex(asked, _WORD).to_pylist() if len(words) else []
        told, rest, form = [], [], []
        for p, ok in zip(words, plain):
            if ok:
                told.append(p)
                w = p if self.spaced else p.strip(" ")
                form.append((w.lower() if self.lower else w).encode())
            else:
                rest.append(p)
        into.update(zip(told, self._packed(self.automaton.encode_words(form))))
        return rest

    def _packed(self, ids: list[list[int]]) -> list[bytes]:
        return [array(self.code, x).tobytes() for x in ids]

    def _split(self, text: str) -> list[bytes]:
        """The pre-split words of a text without added tokens."""
        text = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return [w.translate(self.byte_of).encode("latin-1") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Any texts: added tokens stand for themselves, the rest is split and read."""
        parts: list[list[list[bytes] | int]] = []
        for t in texts:
            own = self.special.split(t) if self.special else [t]
            parts.append([self.specials[p] if i % 2 else self._split(p) for i, p in enumerate(own) if p or i % 2])
        words = list({w for own in parts for p in own if not isinstance(p, int) for w in p})
        ids = dict(zip(words, self.automaton.encode_words(words)))
        return self._packed([[i for p in own for i in ([p] if isinstance(p, int) else
                                                      [x for w in p for x in ids[w]])] for own in parts])


class Labels:
    """The labels of a vocabulary's arcs: ids to text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        decoder = settings["decoder"]
        if decoder is not None and decoder["type"] != "ByteLevel":
            raise ValueError(f"no decoder {decoder['type']}")
        self.joiner = " " if decoder is None else ""
        self.byte_of = {ord(c): b for b, c in _byte_chars().items()} if decoder else None
        named = settings["model"]["vocab"] | {t["content"]: t["id"] for t in settings["added_tokens"]}
        known = [""] * (max(named.values()) + 1)
        for label, i in named.items():
            known[i] = label
        self.known = pa.array(known, pa.large_string())

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The text of each list of ids."""
        offsets = np.asarray(ids.offsets, np.int64)
        labels = self.known.take(ids.flatten().cast(pa.int64()))
        lists = pa.LargeListArray.from_arrays(pa.array(offsets - offsets[0]), labels)
        joined = pc.binary_join(lists, pa.scalar(self.joiner, labels.type))
        if self.byte_of is None:
            return joined
        return pa.array([s.translate(self.byte_of).encode("latin-1").decode("utf-8", "replace") for s in joined.to_pylist()],
                        pa.large_string())


@lru_cache(maxsize=4)
def automaton_encoder(path: str) -> AutomatonEncoder:
    """One compiled automaton per worker process and file."""
    return AutomatonEncoder(path)


@lru_cache(maxsize=4)
def labels(path: str) -> Labels:
    return Labels(path)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every whole text; ``vocabulary`` is the path of
    a tokenizer file with a byte-level BPE model."""
    spark = docs.sparkSession
    ship_package(spark)
    name = ship_file(spark, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = automaton_encoder(shipped_path(name))
        for batch in batches:
            texts = batch.column(1)
            for a, b in blocks(texts, 1 << 22):
                flat, offsets = enc.encode_all(texts.slice(a, b - a))
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], names=["doc_id", "ids"])

    given = docs.select(pick(id_col).cast("long").alias("doc_id"), pick(text_col).cast("string").alias("text"))
    return given.mapInArrow(lambda b: released(run(b)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id``, ``ids`` and decoded, the text that the ids' labels make; null ids
    count as none."""
    spark = encoded.sparkSession
    ship_package(spark)
    name = ship_file(spark, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = labels(shipped_path(name))
        for batch in batches:
            rows = max(1, min(1000, (1 << 20) * len(batch) // max(1, len(batch.column(1).flatten()))))
            for a in range(0, len(batch), rows):
                part = batch.slice(a, rows)
                ids = part.column(1)
                if ids.null_count:
                    ids = pa.array([x or [] for x in ids.to_pylist()], ids.type)
                text = known.decode_all(ids).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, text], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(lambda b: released(run(b)), "doc_id long, ids array<int>, decoded string")
