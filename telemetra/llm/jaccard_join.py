"""Exact n-gram Jaccard self-join by universe-partition pigeonhole.

Sets.  A text is lower-cased in A-Z, cut into words at ASCII white space, and its
distinct word shingles are hashed to 64 bits (shingles count as equal when their
hashes are).  Equal sets form one class, represented by its smallest id; only
classes are joined.

Signatures.  Sizes fall into bands.  Two sets that link, the smaller of band b,
differ in at most U_b shingles, so when the shingles' hash space is cut into
U_b + 1 segments, at least one segment is equal in both.  A set emits a signature
per segment of its own band, and of the band below if it can link into it.

Empty segments would be equal in far too many sets.  They are left out, and the
first K_b segments make up for them: there the one-deletion neighbourhood is emitted
too, so that such a segment differs by 2 where nothing is shared.  A set with k empty
segments and b of the K_b too small to count double keeps the guarantee while
k + b <= K_b; a set beyond that emits its empty segments as well, so two such sets
meet in the plain way.  K_b is chosen by cost: rows added against rows met in the
segments of sets beyond it (:func:`band`).

Join.  Signatures met twice give buckets.  In each the set that shares most
signatures is the centre; every set is compared with the best of its centres, and
linked sets form components.  In larger buckets that hold different components still,
every set is then compared with the centre, which leaves the bucket, in a few rounds, so
that near copies of near copies join without naming all their pairs.  Only pairs of one
bucket in different components are left: they are compared by size and by a 512-bit parity sketch, long sets by one as long
as themselves, whose distances never exceed the true one, before a pair is named, and
those that pass are compared exactly.  So a group of copies costs one
comparison per set, no pair is given up, and every link between different components
is found.

Defined results: a null text and one without words have the empty set (size 0, linked
with nothing); fewer words than the shingle length make one shingle; rows without id
get no component and link nothing; rows that repeat an id count as the classes of
their texts, and the id links these; an empty table gives an empty result; columns
other than id and text are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_mask_table, cut_lineage, discard, has_bit, pick, released, safe_name, ship_package, staged

MASK_BITS = 25
SKETCH_WORDS = 8
SKETCH = [f"w{i}" for i in range(SKETCH_WORDS)]
BLOCK_BYTES = 1 << 21
#: Sets of more shingles than this have a sketch of their own length beside the fixed one.
LONG = 700
#: Buckets of up to so many sets name their pairs before the sketches are read.
FEW = 8
#: A pair of sets is looked for among so many buckets of both, to be named in one only.
FIRST = 16
#: Rounds of centres in larger buckets at most; the last is one that finds no more than
#: an n-th of the links of the round before.
ROUNDS, FEWER = 8, 4
#: A node of more pairs than this (and a thousandth of all) is dealt out in SALTS parts.
HOT_PAIRS, SALTS = 256, 32
#: A pair met in the bucket of an empty segment costs as much as so many signatures.
PAIR_COST = 1.0

_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Band:
    lo: int
    hi: int            # sizes lo <= n < hi
    differ: int        # U: most shingles in which a link of this band differs

    @property
    def segments(self) -> int:
        return self.differ + 1 if self.differ else 0


def band(lo: int, percent: int) -> Band:
    """The band that begins at size ``lo``."""
    hi = max(lo + 1, lo * 10_000 // (percent * percent))
    small = hi - 1
    return Band(lo, hi, max(0, (small + small * 100 // percent) * (100 - percent) // (100 + percent)))


def _beyond(n: int, m: int, k: int) -> float:
    """Share of sets of n shingles in m segments, k of them doubled, whose empty
    segments plus doubled ones of at most one shingle are more than k (segments taken
    as independent: nearly so, and only a cost)."""
    p0 = (1 - 1 / m) ** n
    p1 = min(1 - p0, n / m * (1 - 1 / m) ** (n - 1))
    if m <= 4096:                                   # exact sum of independent segments
        size = 1 << (2 * k + m + 1).bit_length()
        doubled, plain = np.zeros(size), np.zeros(size)
        doubled[:3], plain[:2] = (1 - p0 - p1, p1, p0), (1 - p0, p0)
        chances = np.fft.irfft(np.fft.rfft(doubled) ** k * np.fft.rfft(plain) ** (m - k), size)
        return float(np.clip(chances[k + 1:k + m + 1].sum(), 1e-12, 1))
    mean = (m - k) * p0 + k * (2 * p0 + p1)
    spread = (m - k) * p0 * (1 - p0) + k * (4 * p0 + p1 - (2 * p0 + p1) ** 2)
    return max(1e-12, 0.5 * math.erfc((k + 0.5 - mean) / math.sqrt(2 * max(spread, 1e-9))))


def spare_segments(own: Band, classes: int) -> int:
    """K of a band for so many classes that emit signatures in it."""
    m = own.segments
    if not m or not classes:
        return 0
    n = own.lo                                      # its smallest sets have the most empty segments
    empty = m * (1 - 1 / m) ** n
    some = empty + 3 * math.sqrt(empty) + 1         # empty segments of a set beyond
    steps = range(m + 1) if m <= 48 else sorted(
        {min(m, math.ceil(empty + z / 2 * math.sqrt(empty + 1))) for z in range(41)} | {0, 1, 2, 4, 8, 16})

    def cost(k: int) -> float:
        beyond = _beyond(n, m, k)
        return k * (n / m + 1) + PAIR_COST * beyond * some * classes * beyond * min(1.0, some / m)

    return min(steps, key=cost)


def spares(classes: DataFrame, percent: int) -> list[int]:
    """K of every band for the counted ``classes`` (n): one row per band is collected."""
    table = bands(percent)
    at = F.size(F.filter(F.array(*[F.lit(b.lo) for b in table]), lambda lo: lo <= F.col("n"))) - 1
    count = {r["band"]: r["count"] for r in classes.groupBy(at.alias("band")).count().collect()}
    # a class also emits in the band below its own
    return [spare_segments(b, count.get(i, 0) + count.get(i + 1, 0)) for i, b in enumerate(table)]


@lru_cache(maxsize=8)
def bands(percent: int, upto: int = 1 << 40) -> tuple[Band, ...]:
    out, lo = [], 1
    while lo < upto:
        out.append(band(lo, percent))
        lo = out[-1].hi
    return tuple(out)


def _coefficients(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _C1) | np.uint64(1)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
    data = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    start = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    if not len(start):
        return [np.zeros(0, np.uint64)] * len(texts)
    stop = np.flatnonzero(gap & np.concatenate([[False], ~gap[:-1]]))
    size = stop - start
    at = np.repeat(start, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    inside = at - np.repeat(start, size)
    value = (data[at].astype(np.uint64) + np.uint64(1)) * _coefficients(int(size.max()))[inside]
    word = mix(np.add.reduceat(value, np.cumsum(size) - size) + size.astype(np.uint64) * _C1)
    ends = np.cumsum([len(t) + 1 for t in texts])
    count = np.diff(np.concatenate([[0], np.searchsorted(start, ends)]))
    times = _coefficients(words + 1)
    n = max(0, len(word) - words + 1)
    shingle = np.zeros(n, np.uint64)
    for i in range(words):
        shingle += word[i:i + n] * times[i]
    shingle = mix(shingle)
    out, a = [], 0
    for k in count.tolist():
        if k >= words:
            out.append(np.unique(shingle[a:a + k - words + 1]))
        elif k:
            whole = np.append(word[a:a + k] * times[:k], times[words:] * np.uint64(k)).sum(keepdims=True)
            out.append(mix(whole))
        else:
            out.append(np.zeros(0, np.uint64))
        a += k
    return out


def _blocks(texts: list[str | None]):
    """(first index, encoded texts) of about ``BLOCK_BYTES`` each."""
    first, own, total = 0, [], 0
    for i, t in enumerate(texts):
        own.append((t or "").encode("utf-8", "surrogatepass"))
        total += len(own[-1])
        if total >= BLOCK_BYTES:
            yield first, own
            first, own, total = i + 1, [], 0
    if own:
        yield first, own


def _joined(sets: list[np.ndarray]):
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    return (np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)), size


def _sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    end = np.cumsum(size)
    return total[end] - total[end - size]


def identities(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two 64-bit hashes of each set."""
    flat, size = _joined(sets)
    return size, mix(_sums(mix(flat ^ _C2), size) + size.astype(np.uint64)), mix(_sums(mix(flat ^ _C3), size))


def signatures(sets: list[np.ndarray], percent: int, spare: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, signature) of everything that the sets emit; ``spare`` is K
    of every band."""
    table = bands(percent)
    los = np.array([b.lo for b in table])
    differ, spare = np.array([b.differ for b in table]), np.array(spare)
    flat, size = _joined(sets)
    begin = np.cumsum(size) - size
    own = np.searchsorted(los, size, "right") - 1
    least = -(-size * percent // 100)                       # smallest size it can link with
    lowest = np.searchsorted(los, least, "right") - 1
    views = [(i, b) for i, (n, high, low) in enumerate(zip(size.tolist(), own.tolist(), lowest.tolist())) if n
             for b in range(low, high + 1) if table[b].differ]
    if not views:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    who, which = (np.array(c, dtype=np.int64) for c in zip(*views))
    n, m, k = size[who], differ[which] + 1, spare[which]
    seed = mix((which.astype(np.uint64) + np.uint64(1)) * _C1)
    view = np.repeat(np.arange(len(who)), n)
    token = flat[np.repeat(begin[who] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    value = mix(token + _C1)
    segment = ((mix(token ^ seed[view]) >> np.uint64(32)) * m[view].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    base = np.cumsum(m) - m
    cell = base[view] + segment
    total = np.zeros(int(m.sum()), np.uint64)
    np.add.at(total, cell, value)
    count = np.bincount(cell, minlength=len(total))
    cell_view = np.repeat(np.arange(len(who)), m)
    cell_segment = np.arange(len(total)) - np.repeat(base, m)
    key = mix(seed[cell_view] + (cell_segment.astype(np.uint64) + np.uint64(1)) * _C2)

    def name(sums, sizes, keys):
        return mix(sums + sizes.astype(np.uint64) * _C3 + keys)

    empty = count == 0
    thin = (cell_segment < k[cell_view]) & (count <= 1)
    beyond = np.bincount(cell_view, empty, len(who)) + np.bincount(cell_view, thin, len(who)) > k
    told = ~empty | beyond[cell_view]
    out_view, out_name = [cell_view[told]], [name(total, count, key)[told]]
    spared = np.flatnonzero(segment < k[view])
    at = cell[spared]
    left = count[at] - 1
    fine = (left > 0) | beyond[view[spared]]
    at, spared, left = at[fine], spared[fine], left[fine]
    out_view.append(view[spared])
    out_name.append(name(total[at] - value[spared], left, key[at]))
    return who[np.concatenate(out_view)], np.concatenate(out_name)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Parity of the shingles per bucket, 64 * SKETCH_WORDS buckets."""
    flat, size = _joined(sets)
    bits = 64 * SKETCH_WORDS
    cell = np.repeat(np.arange(len(sets)), size) * bits + (mix(flat + _C3) >> np.uint64(32)).astype(np.int64) % bits
    odd = (np.bincount(cell, minlength=len(sets) * bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8").reshape(len(sets), SKETCH_WORDS)


def long_sketches(sets: list[np.ndarray]) -> pa.Array:
    """For sets above ``LONG`` the parity in a power of two of buckets, at least their
    number, as longs; null for the others.  The halves of a sketch folded by xor give
    the one of half its length."""
    out = []
    for s in sets:
        if len(s) <= LONG:
            out.append(None)
            continue
        bits = 1 << (len(s) - 1).bit_length()
        odd = np.bincount((mix(s + _C3) >> np.uint64(32)).astype(np.int64) % bits, minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8"))
    return pa.array(out, pa.list_(pa.int64()))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def shingle_classes(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, h1, h2, the sketch and the long sketch of every row."""
    def run(batches):
        for batch in batches:
            for first, texts in _blocks(batch.column(1).to_pylist()):
                sets = shingle_sets(texts, words)
                n, h1, h2 = identities(sets)
                sketch = np.ascontiguousarray(sketches(sets).T)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), _long(n), _long(h1), _long(h2), *map(pa.array, sketch),
                     long_sketches(sets)], names=["doc_id", "n", "h1", "h2", *SKETCH, "z"])

    return (docs.select(pick(id_col).cast("long").alias("doc_id"), pick(text_col).cast("string").alias("text"))
            .mapInArrow(lambda b: released(run(b)), "doc_id long, n long, h1 long, h2 long, " + ", ".join(f"{w} long" for w in SKETCH) + ", z array<long>"))


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (u, v) -> (node, component): the smallest node of each component, by
    alternating large-star and small-star rounds until nothing changes."""
    def ordered(e):
        return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def state(e):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    e = staged(ordered(edges))
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = ordered(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, e = e, staged(ordered(small.unionByName(least.select("u", F.col("m").alias("v")))))
        discard(old)
        after = state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _near(x: str, y: str, percent: int) -> Column:
    """Sizes and sketches of two joined rows allow a link: neither the difference of the
    sizes nor the distance of the sketches exceeds that of the sets."""
    def col(side, name):
        return F.col(f"{side}.{name}")

    def within(distance):
        return distance * (100 + percent) <= (col(x, "n") + col(y, "n")) * (100 - percent)

    def apart(a, b):
        return F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)

    def folded(z):
        half = (F.size(z) / 2).cast("int")
        return F.zip_with(F.slice(z, F.lit(1), half), F.slice(z, half + 1, half), lambda p, q: p.bitwiseXOR(q))

    short = sum((F.bit_count(col(x, w).bitwiseXOR(col(y, w))) for w in SKETCH), F.lit(0))
    a, b = col(x, "z"), col(y, "z")
    long = (F.when(a.isNull() | b.isNull(), F.lit(0)).when(F.size(a) == F.size(b), apart(a, b))
            .when(F.size(a) == 2 * F.size(b), apart(folded(a), b)).when(F.size(b) == 2 * F.size(a), apart(a, folded(b)))
            .otherwise(F.lit(0)))
    return within(F.abs(col(x, "n") - col(y, "n"))) & within(short) & within(long)


def _shingles(rows: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, n, shingles) of the ``nodes`` (a few more may come through)."""
    def run(batches):
        for batch in batches:
            for first, texts in _blocks(batch.column(1).to_pylist()):
                sets = shingle_sets(texts, words)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["node", "n", "shingles"])

    return _masked(rows, nodes).mapInArrow(lambda b: released(run(b)), "node long, n long, shingles binary")


def _masked(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows whose id is one of ``nodes``, and a few more: a fixed-size mask is sent."""
    masks = bit_mask_table(nodes.select(F.xxhash64("node").alias("h")), "h", MASK_BITS)
    return has_bit(rows.withColumn("h", F.xxhash64("doc_id")), "h", masks, MASK_BITS, "hit").where("hit").select(
        "doc_id", "text")


def _beside(pairs: DataFrame, column: str, facts: DataFrame) -> DataFrame:
    """``pairs`` (a written table) joined with the ``facts`` of the node in ``column``
    (facts has it under that name).  A node of very many pairs is dealt out: its pairs
    by a salt, its one row to every salt."""
    limit = max(HOT_PAIRS, pairs.count() // 1024)               # so at most 1024 nodes are hot
    hot = F.broadcast(cut_lineage(pairs.groupBy(column).count().where(F.col("count") > limit)
                                  .select(column, F.lit(True).alias("hot"))))
    other = "a" if column == "b" else "b"
    left = pairs.join(hot, column, "left").withColumn("salt", F.when(
        F.col("hot"), F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")).otherwise(0)).drop("hot")
    right = facts.join(hot, column, "left").withColumn("salt", F.explode(F.when(
        F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("hot")
    return left.join(right, [column, "salt"]).drop("salt")


def _verify(pairs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets link."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = cut_lineage(_shingles(rows, nodes, words).distinct())
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("xa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("xb"))
    both = _beside(pairs, "b", right).join(left, "a").select("a", "b", "na", "nb", "xa", "xb")

    def linked(na, nb, x, y):
        same = na + nb - len(np.union1d(x, y))
        return 100 * same >= percent * (na + nb - same)

    def run(batches):
        for batch in batches:
            hit = [linked(na, nb, np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"))
                   for na, nb, x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(),
                                           batch.column(4), batch.column(5))]
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest id reachable by
    links (100 * intersection >= percent * union)."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(pick(id_col).cast("long").alias("doc_id"), pick(text_col).cast("string").alias("text"))
    members = cut_lineage(shingle_classes(rows, words))
    classes = cut_lineage(members.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "h1", "h2", *SKETCH)
                          .agg(F.min("doc_id").alias("node")))
    longer = members.where("z IS NOT NULL").select(F.col("doc_id").alias("node"), "n", "h1", "h2", "z").dropDuplicates(["node", "n", "h1", "h2"])
    classes = cut_lineage(classes.join(longer, ["node", "n", "h1", "h2"], "left"))
    links = _links(rows, classes, words, percent)
    # an id that stands at several texts links their classes
    several = (members.where("n > 0").join(classes.select("n", "h1", "h2", "node"), ["n", "h1", "h2"]).where("doc_id <> node")
               .select(F.col("doc_id").alias("u"), F.col("node").alias("v")))
    several = several.join(classes.select(F.col("node").alias("u")).distinct(), "u", "left_semi")
    named = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(several))
    found = classes.drop("z").join(named, "node", "left").select(
        "n", "h1", "h2", F.coalesce("component", "node").alias("found"))
    return members.join(found, ["n", "h1", "h2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"))


def near_distinct(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` without those that link, directly or not, with a smaller id; rows
    without id stay.  An id that stands at several texts names a row of each: a row
    goes only if its own text links with that of a smaller id (ties: the smaller
    SHA-256 of the text, then of the whole row) or it repeats an id and its text.
    Ids that may go are sent as a mask of fixed size; only their rows are shuffled
    to be looked up."""
    repeated = docs.select(pick(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").groupBy("doc_id").count()
    if not repeated.where("count > 1").isEmpty():
        return _near_distinct_rows(docs, words, percent, id_col, text_col)
    found = cut_lineage(jaccard_components(docs, words, percent, id_col, text_col))
    key, hit = safe_name(docs, "__nd_key"), safe_name(docs, "__nd_hit")
    gone = found.where("doc_id <> component_id").select("doc_id")
    masks = bit_mask_table(gone.select(F.xxhash64("doc_id").alias("h")), "h", MASK_BITS)
    marked = has_bit(docs.withColumn(key, F.xxhash64(pick(id_col).cast("long"))), key, masks, MASK_BITS, hit)
    asked = marked.where(F.col(hit)).withColumn(key, pick(id_col).cast("long"))
    stay = asked.join(gone.select(F.col("doc_id").alias(key)), key, "left_anti")
    return marked.where(~F.col(hit)).unionByName(stay.select(marked.columns)).drop(key, hit)


def _near_distinct_rows(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """:func:`near_distinct` where ids repeat: the rows are written with a number of
    their own, the numbers are joined, and of each component the first row stays."""
    key = safe_name(docs, "__nd_key")
    rows = cut_lineage(docs.withColumn(key, F.monotonically_increasing_id()))
    named = rows.where(pick(id_col).cast("long").isNotNull())
    found = jaccard_components(named, words, percent, key, text_col).select(
        F.col("doc_id").alias("key"), F.col("n_shingles").alias("n"), F.col("component_id").alias("component"))
    order = named.select(F.col(key).alias("key"), pick(id_col).cast("long").alias("id"),
                         F.sha2(F.coalesce(pick(text_col).cast("string"), F.lit("")), 256).alias("digest"),
                         F.sha2(F.to_json(F.struct(*[pick(c) for c in docs.columns])), 256).alias("whole"))
    # a row without words links with nothing but the repeats of its id and text
    wordless = F.col("n") == 0
    groups = cut_lineage(order.join(found, "key").select(
        "key", "id", "digest", "whole", F.when(~wordless, F.col("component")).alias("g1"),
        F.when(wordless, F.col("id")).alias("g2"), F.when(wordless, F.col("digest")).alias("g3")))
    first = groups.groupBy("g1", "g2", "g3").agg(F.min(F.struct("id", "digest", "whole", "key"))["key"].alias("key"))
    gone = groups.select("key").join(first, "key", "left_anti").select(F.col("key").alias(key))
    return rows.join(gone, key, "left_anti").select(*[pick(c) for c in docs.columns])


def _fame(met: DataFrame) -> DataFrame:
    """How many buckets a node is in."""
    return met.groupBy("node").agg(F.count(F.lit(1)).alias("fame"))


def _compared(pairs: DataFrame, sketch: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The links among the ``pairs`` (a, b) of sets and their centres."""
    facts = sketch.select(F.col("node").alias("b"), F.struct("n", *SKETCH, "z").alias("y"))
    near = (_beside(cut_lineage(pairs), "b", facts).join(sketch.alias("x"), F.col("a") == F.col("x.node"))
            .where(_near("x", "y", percent)).select("a", "b").distinct())
    return cut_lineage(_verify(cut_lineage(near), rows, words, percent))


def _unsettled(met: DataFrame, links: DataFrame) -> DataFrame:
    """The buckets (sig, node) whose sets the ``links`` leave in different components:
    sig, node, component and the bucket's size, written."""
    component = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    rest = met.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (rest.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.count(F.lit(1)).alias("size")).where("lo < hi").select("sig", "size"))
    return staged(rest.select("sig", "node", "component").join(mixed, "sig"))


def _apart(side: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides of the pairs of one bucket (sig) in different components, and the condition."""
    x, y = side.alias("x"), side.alias("y")
    return x, y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.component") < F.col("y.component"))


def _named(large: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of the ``large`` buckets (sig, node, component, size) whose sizes
    and sketches allow a link.  A row carries the first ``FIRST`` buckets of its set, the
    largest first, and a pair that has common ones among them is named in the first of
    these alone: no common bucket comes before it.  Without any it is named in every
    bucket of both."""
    order = F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("size"), "sig")))
    first = large.groupBy("node").agg(F.slice(order, 1, FIRST)["sig"].alias("first"))
    x, y, apart = _apart(large.join(sketch, "node").join(first, "node"))
    common = F.array_intersect("x.first", "y.first")
    here = F.coalesce(F.get(common, F.lit(0)), F.col("x.sig")) == F.col("x.sig")
    return x.join(y, apart & here & _near("x", "y", percent)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _links(rows: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between representatives that span every component."""
    reps = _masked(rows, classes)
    spare = spares(classes, percent)

    def emit(batches):
        for batch in batches:
            for _, texts in _blocks(batch.column(1).to_pylist()):
                sets = shingle_sets(texts, words)
                _, h1, _ = identities(sets)
                who, sig = signatures(sets, percent, spare)
                ent = h1[who]
                for i in range(0, len(sig), 1 << 17):
                    yield pa.RecordBatch.from_arrays([_long(sig[i:i + (1 << 17)]), _long(ent[i:i + (1 << 17)])],
                                                     names=["sig", "h1"])

    told = staged(reps.mapInArrow(lambda b: released(emit(b)), "sig long, h1 long"))
    # counted by 40 of the 64 bits: fewer bytes to shuffle; what collides goes at `shared`
    key = F.shiftright("sig", 24)
    again = told.groupBy(key.alias("key")).count().where("count > 1").select("key")
    met = has_bit(told.withColumn("key", key), "key", bit_mask_table(again, "key", MASK_BITS), MASK_BITS, "met")
    met = met.where("met").drop("met", "key")
    met = met.join(classes.select("h1", "node"), "h1").select("sig", "node").distinct()
    met = staged(met)
    discard(told)
    shared = met.groupBy("sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("sig")
    every, met = met, staged(met.join(shared, "sig"))
    discard(every)

    # every set with the best of its centres
    sketch = classes.select("node", "n", *SKETCH, "z")
    famed = met.join(_fame(met), "node")
    centre = famed.groupBy("sig").agg(F.max(F.struct("fame", "node")).alias("c"))
    best = (famed.join(centre, "sig").where("node <> c.node").groupBy("node").agg(F.max("c").alias("c"))
            .select(F.col("node").alias("a"), F.col("c.node").alias("b")))
    links = _compared(best, sketch, rows, words, percent)
    rest = _unsettled(met, links)
    discard(met)

    # sets of larger buckets with all their centres; a bucket whose centre links with none
    # in it leaves the rounds, so that a round reads only what the one before joined
    before, written = 0, [rest]
    large, aside = rest.where(F.col("size") > FEW), [rest.where(F.col("size") <= FEW)]
    for _ in range(ROUNDS):
        if large.isEmpty():
            break
        centre = large.join(_fame(large), "node").groupBy("sig").agg(F.max(F.struct("fame", "node", "component")).alias("c"))
        centre = cut_lineage(centre.select("sig", F.col("c.node").alias("b"), F.col("c.component").alias("of")))
        asked = cut_lineage(large.join(centre, "sig").where("component <> of").select("sig", F.col("node").alias("a"), "b"))
        more = _compared(asked.select("a", "b").distinct(), sketch, rows, words, percent)
        links = links.unionByName(more)
        joined = asked.join(more, ["a", "b"], "left_semi").select("sig").distinct().withColumn("joined", F.lit(True))
        # the pairs of a centre are settled: it leaves its bucket
        left = staged(large.join(centre, "sig").where("node <> b").join(joined, "sig", "left")
                      .select("sig", "node", F.coalesce("joined", F.lit(False)).alias("joined")))
        again = _unsettled(left.where("joined").select("sig", "node"), links)
        written += [left, again]
        aside += [left.where("NOT joined"), again.where(F.col("size") <= FEW)]
        large = again.where(F.col("size") > FEW)
        before, least = more.count(), before / FEWER
        if before <= least:
            break
    if len(written) > 1:
        left = large.select("sig", "node")
        for part in aside:
            left = left.unionByName(part.select("sig", "node"))
        rest = _unsettled(left, links)
        for old in written:
            discard(old)

    # pairs of one bucket whose sets are in different components still;
    # small buckets repeat the same few pairs: name the pairs, then look at the sketches
    x, y, apart_few = _apart(rest.where(F.col("size") <= FEW))
    few = x.join(y, apart_few).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    few = (few.join(sketch.alias("x"), F.col("a") == F.col("x.node")).join(sketch.alias("y"), F.col("b") == F.col("y.node"))
           .where(_near("x", "y", percent)).select("a", "b"))
    many = _named(rest.where(F.col("size") > FEW), sketch, percent)
    pairs = cut_lineage(few.unionByName(many).distinct())
    discard(rest)
    return links.unionByName(_verify(pairs, rows, words, percent))
