"""Language identification of mixed-language text.

Training counts hashed character 3- and 4-grams of words (with word boundaries) and
the scripts of letters per language, over a sample of labelled rows that is bounded
(``SAMPLE_DOCS`` rows expected per language, picked by hash); the model is one table
of ``2 ** BITS`` log probabilities per language (at most ``MAX_LANGUAGES``).

Prediction reads whole texts.  The script of a word (by code-point range) narrows
its candidate languages to those that use the script; the word's score in each is
the sum of its n-grams' log probabilities; Viterbi over the words with a penalty per
switch labels spans.  Where the gains of leaving a text's best single language sum,
over any run of words, to at most half a penalty, no switch can pay and the single
label is optimal; only other texts go through the recursion, many at a time.

Defined results: a text that is null or has no letter is ``und`` with score 0; a
text whose letters are all of unseen scripts is judged by n-grams among all
languages; without any labelled row all are ``und``; the score is the predicted
language's share of the text's letters; an input column named like an output is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, released, safe_name, ship_package

SAMPLE_DOCS = 2_000
TRAIN_TASKS = 8
#: Labels that are learned at most: those with the most rows (ties by name).
MAX_LANGUAGES = 512
BITS = 16
SWITCH_PENALTY = 20.0
#: A language uses a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.002
LABEL = "struct<lang:string,score:double,spans:array<struct<start:int,end:int,lang:string>>>"
#: First code points of script ranges (fixed values of Unicode's blocks); a letter
#: belongs to the last range that begins at or before it.
SCRIPT_STARTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "latin"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"),
    (0x3190, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"),
    (0xD7FC, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0xFB50, "arabic"),
    (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPTS = sorted({s for _, s in SCRIPT_STARTS})


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray        # [2 ** BITS, languages] log probabilities
    scripts: np.ndarray        # [scripts, languages] True: the language uses the script


class _Tables:
    """Per code point: is it a letter, its lower-case form, its script."""
    _made = None

    def __init__(self):
        n = 0x110000
        self.letter = np.fromiter((chr(c).isalpha() for c in range(n)), bool, n)
        self.lower = np.arange(n, dtype=np.uint32)
        for c in np.flatnonzero(self.letter).tolist():
            low = chr(c).lower()
            if len(low) == 1:
                self.lower[c] = ord(low)
        starts = [s for s, _ in SCRIPT_STARTS]
        names = np.array([SCRIPTS.index(s) for _, s in SCRIPT_STARTS], dtype=np.uint8)
        self.script = names[np.searchsorted(starts, np.arange(n), "right") - 1]

    @classmethod
    def get(cls):
        if cls._made is None:
            cls._made = cls()
        return cls._made


def _words(texts: list[str]):
    """Hashed n-grams and words of texts.  Returns letter positions, the 3- and
    4-gram bucket of each letter (4-gram -1 if the next is no letter), the index in
    the letters of each word's first letter, code points, and text bounds."""
    t = _Tables.get()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = t.letter[codes]
    c = np.zeros(len(codes) + 3, dtype=np.uint64)
    c[1:-2] = np.where(letter, t.lower[codes], 0)
    at = np.flatnonzero(letter)
    a, b, d, e = c[at], c[at + 1], c[at + 2], c[at + 3]
    k1, k2, k3, k4 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    shift = np.uint64(64 - BITS)
    tri = a * k1 + b * k2 + d * k3
    four = tri * k2 + e * k4 + k1
    mix = np.uint64(0xFF51AFD7ED558CCD)
    tri = (((tri ^ (tri >> np.uint64(31))) * mix) >> shift).astype(np.int32)
    four = (((four ^ (four >> np.uint64(31))) * mix) >> shift).astype(np.int32)
    four[d == 0] = -1
    first = np.flatnonzero(a == 0)
    return at, tri, four, first, codes, np.cumsum(sizes) - sizes


def _text_blocks(texts: list[str], chars: int):
    """Runs of texts of about ``chars`` characters (one text may be longer)."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t) + 1
        if total >= chars:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
          sample_docs: int = SAMPLE_DOCS, max_languages: int = MAX_LANGUAGES) -> Model:
    """Learn from rows with a non-null language and text: of the ``max_languages`` labels
    with the most rows about ``sample_docs`` rows each.  The model has 256 KB a label."""
    spark = labelled.sparkSession
    ship_package(spark)
    rows = labelled.select(pick(lang_col).cast("string").alias("lang"), pick(text_col).cast("string").alias("text"),
                           F.xxhash64(pick(id_col), pick(text_col)).alias("h")).where("lang IS NOT NULL AND text IS NOT NULL")
    most = rows.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(max_languages)
    counts = most.collect()                                          # bounded
    if not counts:
        return Model((), np.zeros((1 << BITS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    rates = spark.createDataFrame([(r["lang"], min(1 << 40, int(sample_docs / r["count"] * (1 << 40)))) for r in counts],
                                  "lang string, rate long")
    sample = (rows.join(F.broadcast(rates), "lang").where(F.pmod("h", F.lit(1 << 40)) < F.col("rate"))
              .select("lang", "text").repartition(TRAIN_TASKS))

    def count(batches):
        # a label's counts are sparse here: few rows have few n-grams
        told = {"lang": [], "bucket": [], "seen": [], "scripts": []}
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for i, j in _text_blocks(texts, 1 << 21):
                    at, tri, four, _, codes, _ = _words(texts[i:j])
                    bucket, seen = np.unique(np.concatenate([tri, four[four >= 0]]), return_counts=True)
                    used = np.bincount(_Tables.get().script[codes[at]], minlength=len(SCRIPTS))
                    for name, value in zip(told, (lang, bucket.astype("<u4").tobytes(), seen.astype("<u4").tobytes(),
                                                  used.astype("<i8").tobytes())):
                        told[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(told["lang"], pa.string()), *(pa.array(told[c], pa.binary()) for c in (
                "bucket", "seen", "scripts"))], names=list(told))
            told = {name: [] for name in told}

    grams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for r in sample.mapInArrow(lambda b: released(count(b)), "lang string, bucket binary, seen binary, scripts binary").toLocalIterator():
        own = grams.setdefault(r["lang"], np.zeros(1 << BITS, np.float32))
        own[np.frombuffer(r["bucket"], "<u4")] += np.frombuffer(r["seen"], "<u4")
        scripts[r["lang"]] = scripts.get(r["lang"], 0) + np.frombuffer(r["scripts"], "<i8")
    langs = tuple(sorted(k for k in grams if grams[k].sum()))
    if not langs:
        return Model((), np.zeros((1 << BITS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    weights = np.empty((1 << BITS, len(langs)), np.float32)
    for i, k in enumerate(langs):
        g = grams.pop(k).astype(float) + 0.05
        weights[:, i] = np.log(g / g.sum())
    s = np.stack([scripts[k] for k in langs], axis=1).astype(float)
    return Model(langs, weights, s / s.sum(axis=0) >= SCRIPT_SHARE)


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The best label per word of several texts; a switch costs ``penalty``."""
    n, width = len(scores), scores[0].shape[1]
    order = sorted(range(n), key=lambda i: -len(scores[i]))
    sizes = np.array([len(scores[i]) for i in order])
    longest = int(sizes[0])
    value = np.zeros((n, width))
    stay = [np.zeros(0)] * longest
    source = [np.zeros(0)] * longest
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate([scores[i] for i in order]).astype(float)
    alive = np.searchsorted(-sizes, -np.arange(longest), "left")      # texts with a word at t
    for t in range(longest):
        m = int(alive[t])
        if t:
            top = value[:m].max(axis=1) - penalty
            source[t] = value[:m].argmax(axis=1)
            stay[t] = value[:m] >= top[:, None]
            value[:m] = np.maximum(value[:m], top[:, None])
        value[:m] += flat[bounds[:m] + t]
    labels = np.zeros(len(flat), dtype=np.int64)
    state = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        m = int(alive[t])
        labels[bounds[:m] + t] = state[:m]
        if t:
            state[:m] = np.where(stay[t][np.arange(m), state[:m]], state[:m], source[t])
    out: list[np.ndarray] = [np.zeros(0)] * n
    for k, i in enumerate(order):
        out[i] = labels[bounds[k]:bounds[k + 1]]
    return out


def label_texts(texts: list[str | None], model: Model, penalty: float = SWITCH_PENALTY) -> list[dict]:
    """{lang, score, spans} of each text."""
    none = {"lang": "und", "score": 0.0, "spans": []}
    out: list[dict] = [none] * len(texts)
    width = len(model.languages)
    given = [i for i, t in enumerate(texts) if t]
    if not width or not given:
        return out
    hard: list[tuple] = []
    chars = max(1 << 16, (1 << 22) // (width + 4))
    for i, j in _text_blocks([texts[k] for k in given], chars):
        _label_block(given[i:j], [texts[k] for k in given[i:j]], model, penalty, out, hard)
    if hard:
        for (k, _, letters, begin, end), labels in zip(hard, viterbi([h[1] for h in hard], penalty)):
            out[k] = _summary(labels, letters, begin, end, model)
    return out


def _label_block(which, texts, model, penalty, out, hard):
    at, tri, four, first, codes, bounds = _words(texts)
    if not len(first):
        return
    score = model.weights[tri]
    has = four >= 0
    score[has] += model.weights[four[has]]
    words = np.add.reduceat(score, first, axis=0)
    candidates = model.scripts[_Tables.get().script[codes[at[first]]]]
    candidates |= ~candidates.any(axis=1, keepdims=True)
    words[~candidates] = -1e6
    last = np.append(first[1:], len(at)) - 1
    begin, end = at[first], at[last] + 1
    letters = end - begin
    doc = np.searchsorted(bounds, begin, "right") - 1
    fresh = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    stop = np.append(fresh[1:], len(doc))
    whole = np.add.reduceat(words.astype(float), fresh, axis=0)
    best = whole.argmax(axis=1)
    gain = words - words[np.arange(len(words)), np.repeat(best, stop - fresh)][:, None]
    easy = (np.add.reduceat(np.maximum(gain, 0).astype(float), fresh, axis=0).max(axis=1) <= penalty / 2)
    for k in range(len(fresh)):
        a, b = int(fresh[k]), int(stop[k])
        d, base = int(doc[a]), int(bounds[doc[a]])
        if not easy[k]:
            run = np.concatenate([np.zeros((1, gain.shape[1])), np.cumsum(gain[a:b].astype(float), axis=0)])
            easy[k] = (run - np.minimum.accumulate(run, axis=0)).max() <= penalty / 2
        if easy[k]:
            out[which[d]] = {"lang": model.languages[best[k]], "score": 1.0, "spans": [
                {"start": int(begin[a]) - base, "end": int(end[b - 1]) - base, "lang": model.languages[best[k]]}]}
        else:
            hard.append((which[d], words[a:b].copy(), letters[a:b], begin[a:b] - base, end[a:b] - base))


def _summary(labels, letters, begin, end, model):
    share = np.bincount(labels, weights=letters, minlength=len(model.languages))
    top = int(share.argmax())
    change = np.flatnonzero(np.append(True, labels[1:] != labels[:-1]))
    stop = np.append(change[1:], len(labels)) - 1
    return {"lang": model.languages[top], "score": float(share[top] / share.sum()), "spans": [
        {"start": int(begin[a]), "end": int(end[z]), "lang": model.languages[labels[a]]} for a, z in zip(change, stop)]}


_TYPE = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct(
    [("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))])


def identify(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``lang_spans`` (code points)."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(LABEL)
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def run():
            for texts in batches:
                parts = [label_texts(texts.slice(i, 2000).to_pylist(), sent.value, penalty)
                         for i in range(0, len(texts), 2000)]
                yield pa.array([d for p in parts for d in p], _TYPE)

        yield from released(run())

    out = {"lang_pred": "lang", "score": "score", "lang_spans": "spans"}
    work = safe_name(docs, "__li")
    kept = [c for c in docs.columns if c.lower() not in out]
    labelled = docs.withColumn(work, label(pick(text_col).cast("string")))
    return labelled.select(*[pick(c) for c in kept], *[F.col(f"`{work}`.{f}").alias(n) for n, f in out.items()])


def held_out(id_col: str = "doc_id"):
    """Rows that training never sees: crc32 of the id as text leaves 2 mod 4."""
    return F.coalesce(F.crc32(pick(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
