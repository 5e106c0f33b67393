"""Every registered corpus query on a small table, whole rows against plain Python."""

import collections
import hashlib
import itertools
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from telemetra.llm import common, exact_dedup, jaccard_join, language_id, mixing, packing, queries, topk, warc

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

EN = "the report of the year and the work that was done with this in the town for all of them to see and read again "
DE = "der bericht und die arbeit die nicht mit dem plan von der stadt auf das jahr ist und wir sind für den rest da "
SCHEMA = "doc_id long, text string, lang string, source string, size string, kept string, start int, position string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def _documents():
    rng = np.random.default_rng(12)
    texts = []
    for i in range(40):
        words = rng.permutation(((EN, DE)[i % 2] * 2).split()).tolist()
        texts.append(" ".join(words))
        if i % 5 == 0:                               # near copies
            texts.append(" ".join([*words[:-1], "other"]))
        if i % 8 == 0:                               # exact copies
            texts.append(" ".join(words))
    texts += [None, "", "   \n\t ", "two words", "Two words", "12 34 !", "mail a.b@c.org now, 4111 1111 1111 1111 or 10.0.0.255",
              "call +1 (555) 123-4567 or +49 30 1234567; 256.1.1.1 and 1.2.3.4.5, 4111-1111-1111-1112",
              "日本語 の テキスト", "a\nb\n\nc", "<P>x", "x" * 5000]
    def language(t):
        return "de" if "und" in (t or "").split() else "en"

    rows = [(i * 3 + 1, t, None if i % 7 == 0 else language(t), None if i % 9 == 4 else ("s0", "s1", "hot", "hot")[i % 4],
             "own size", "own kept", i, "own position") for i, t in enumerate(texts)]
    return rows + [(500, rows[3][1], "en", "hot", "z", "k", 1, "p"), (500, "other text of five hundred", "en", "hot", "z", "k", 2, "p"),
                   (500, "other text of five hundred", "en", "hot", "z", "k", 2, "p"), (None, "no id of its own here", "en", None, "z", "k", 3, "p")]


@pytest.fixture(scope="module")
def docs():
    return _documents()


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "u", "<p>" + "é" * 600), (2, "u", "<p>" + "é" * 600), (9, None, "<p>" + "é" * 600), (3, "u", None), (4, "u", ""),
                           (5, "u", "s"), (6, "u", "s")], "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(320, 5)).round(1))]
    vectors += [(100, [1.0] * 5), (100, [0.5] * 5), (None, [9.0] * 5), (900, None), (1000, [float("inf")] * 5), (400, [0.0] * 5)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.fixture(scope="module")
def empty_folder(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none"))
    for name in ("documents", "pages", "embeddings"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return path


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty_folder, name):
    df = queries.QUERIES[name](spark, empty_folder)
    assert df.count() == 0 and df.columns


@pytest.mark.parametrize("name", [n for n in sorted(queries.SQL) if n != "op9_topk"])
def test_query_equals_its_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    found, want = queries.QUERIES[name](spark, folder), con.sql(queries.SQL[name])
    assert sorted(found.columns) == sorted(want.columns)

    def plain(rows, names):
        at = [names.index(c) for c in sorted(names)]
        return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in at) for r in rows), key=repr)

    got, sql = plain([tuple(r) for r in found.collect()], found.columns), plain(want.fetchall(), want.columns)
    if name == "op1_exact_dedup":                   # of rows that repeat id and text one is kept, the SQL keeps all
        got, sql = (sorted(((*r[:3], *r[4:]) for r in x), key=repr) for x in (got, sql))
    assert got == sql


def test_op2_pieces(spark, folder, docs):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = queries.op2_packing(spark, folder).collect()
    ids = {}
    for i, t, *_ in docs:
        ids.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    by = collections.defaultdict(list)
    for r in rows:
        assert any(r.ids_crc32 == zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes()) and r.doc_tokens == len(x)
                   for x in ids[r.doc_id])
        by[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(len(x) for own in ids.values() for x in own)
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 4096
    for i, own in ids.items():
        if len(own) == 1:
            parts = sorted((r.start, r.length) for r in rows if r.doc_id == i)
            assert [s for s, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
            assert sum(n for _, n in parts) == len(own[0])
    assert len(by) == -(-sum(r.length for r in rows) // 4096)         # hardly any padding


def test_packing_with_prompts_binds_the_third_limit(spark, docs):
    df = spark.createDataFrame([(i, "word " * (i % 30 + 1), i % 30 // 2) for i in range(200)], "doc_id long, text string, prompt long")
    limits = packing.Limits(tokens=64, segments=6, loss=24, slack=2)
    rows = packing.pack(df, P.path("word_bpe_49k.json"), limits, prompt_tokens_col="prompt").collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
        head = r.doc_id % 30 // 2
        assert r.loss_tokens == r.length - max(0, min(head, r.start + r.length) - r.start)
    assert all(sum(r.length for r in own) <= 64 and len(own) <= 6 and sum(r.loss_tokens for r in own) <= 24 for own in by.values())
    assert any(sum(r.loss_tokens for r in own) >= 22 and sum(r.length for r in own) < 50 for own in by.values())
    assert sum(r.length for r in rows) == sum(i % 30 + 2 for i in range(200))


def test_op4_files(spark, folder, docs):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = sorted(queries.op4_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    assert [r.doc_id for r in rows] == sorted((i for i, *_ in docs), key=lambda i: (i is not None, i or 0))
    want = sorted((str(i), zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()))
                  for i, t, *_ in docs)
    assert sorted((str(r.doc_id), r.ids_crc32) for r in rows) == want


def test_op5_languages(spark, folder, docs):
    rows = queries.op5_language_id(spark, folder).collect()
    assert len(rows) == len(docs)
    texts = collections.defaultdict(set)
    for i, t, *_ in docs:
        texts[i].add(t)
    right = seen = 0
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        own = next(iter(texts[r.doc_id]))
        if len(texts[r.doc_id]) == 1 and not any(c.isalpha() for c in own or ""):
            assert r.lang_pred == "und" and r.score == 0
        elif own and len(own) > 150 and r.held_out:
            seen += 1
            right += r.lang_pred == ("de" if "und" in own.split() else "en")
    assert {r.lang_pred for r in rows} == {"und", "en", "de"} and seen and right >= 0.9 * seen


def test_three_hundred_labels(spark):
    rng = np.random.default_rng(5)
    words = {k: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for k in range(300)}
    rows = [(i, " ".join(rng.choice(words[i % 300], 30)), f"l{i % 300:03d}", "s") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language_id.train(df)
    assert len(model.languages) == 300
    got = language_id.identify(df, model).collect()
    assert sum(r.lang_pred == f"l{r.doc_id % 300:03d}" for r in got) >= 0.95 * len(got)
    assert len(language_id.train(df, max_languages=7).languages) == 7
    kept = corpus_pipeline.identify_language(spark, df, "")
    assert kept.count() == 1500 and kept.columns == df.columns


def test_labels_equal_plain_viterbi(spark):
    rng = np.random.default_rng(6)
    rows = [(i, t, l) for i, (t, l) in enumerate([(EN, "en"), (DE, "de"), ("le rapport de la ville et les gens sont avec nous pour un an ", "fr")] * 9)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    pool = (EN + DE + "le rapport de la ville et les gens sont avec nous pour un an x 日本 Ωμέγα").split()
    texts = [" ".join(rng.choice(pool, rng.integers(1, 40))) for _ in range(300)]

    def plain(text):
        at, tri, four, first, codes, _ = language_id._words([text])
        if not len(first):
            return "und"
        score = model.weights[tri].copy()
        score[four >= 0] += model.weights[four[four >= 0]]
        words = np.add.reduceat(score, first, axis=0)
        script = language_id._Tables.get().script[codes[at[first]]]
        may = model.scripts[script]
        may = may | ~may.any(axis=1, keepdims=True)
        words = np.where(may, words, -1e6).astype(float)
        best, back = words[0], []
        for w in words[1:]:
            jump = best.max() - language_id.SWITCH_PENALTY
            back.append(np.where(best >= jump, np.arange(len(best)), best.argmax()))
            best = np.maximum(best, jump) + w
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        sizes = np.diff(np.append(first, len(at)))
        letters = np.array([at[min(len(at), f + n) - 1] + 1 - at[f] for f, n in zip(first, sizes)])
        share = np.bincount(path[::-1], weights=letters, minlength=len(model.languages))
        return model.languages[int(share.argmax())]

    got = [r["lang"] for r in language_id.label_texts(texts, model)]
    assert got == [plain(t) for t in texts]


def test_op7_base_kinds(spark, folder, docs):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0

    def fits(kind, s):
        d = re.sub(r"\D", "", s)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in s.split(".")),
                "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]

    want = []
    for i, t, *_ in docs:
        own = {k: [m.span() for m in re.finditer(p, t or "", re.A) if fits(k, m[0])] for k, p in patterns.items()}
        told = ",".join(f"{k}:{a}:{b}" for k in patterns for a, b in own[k])
        want.append((str(i), *(len(own[k]) for k in patterns), _sha(told)))
    got = queries.op7_pii(spark, folder).collect()
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == sorted(want)
    for r in got:
        base = [s for s in r.spans.split(",") if s.split(":")[0] in patterns]
        assert _sha(",".join(base)) == r.base_sha256
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got) >= 6


def test_op8_shards(spark, folder, docs):
    rows = queries.op8_sharding(spark, folder).collect()
    want = sorted((str(i), 8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t, *_ in docs)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    for s in range(24):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert {r.law for r in rows} == {"bytes"} and all(0 <= r.shard < 24 and r.grown_shard is None for r in rows)


def test_op9_scores(spark, folder):
    rows = queries.op9_topk(spark, folder).collect()
    vectors = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in
               ((r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect())
               if v is not None and all(np.isfinite(v))]
    for q in {i for i, _ in vectors if i is not None and i % 100 == 0}:
        ask = max(v for i, v in vectors if i == q)
        others = sorted((-sum(a * b for a, b in zip(ask, v)), i is None, i or 0) for i, v in vectors if i != q)
        got = sorted((r["rank"], -r.score) for r in rows if r.query_id == q)
        assert got == [(k + 1, s) for k, (s, _, _) in enumerate(others[:10])]
    assert topk.top_k(topk.integer_vectors(spark.read.parquet(f"{folder}/embeddings.parquet")).where("vec_id < 3"),
                      F.col("vec_id") == 0, 10).count() == 2


def _linked(texts, words, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    root = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root = [root[a] if r == root[b] else r for r in root]
    return sets, root


def test_op10_sets_and_components(spark, folder, docs):
    sets, root = _linked([t for _, t, *_ in docs], 4, 85)
    rows = queries.op10_jaccard_join(spark, folder).collect()
    assert sorted((str(r.doc_id), r.n_shingles) for r in rows) == sorted((str(d[0]), len(s)) for d, s in zip(docs, sets))
    ids = {}
    for d, r in zip(docs, root):
        ids.setdefault(r, set()).add(d[0])
    whole = {i: min(x for own in ids.values() if i in own for x in own if x is not None) for i in {d[0] for d in docs} - {None, 500}}
    got = {r.doc_id: r.component_id for r in rows}
    # the id 500 stands at two texts and links their groups
    assert all(got[i] == c for i, c in whole.items() if 500 not in next(o for o in ids.values() if i in o))
    assert got[None] is None and got[500] == min(min(x for x in o if x is not None) for o in ids.values() if 500 in o)


def _signature_pairs(n, low, high, seed=1):
    """Pairs that n unrelated sets make in buckets."""
    rng = np.random.default_rng(seed)
    sets = [np.unique(rng.integers(0, 1 << 63, s, dtype=np.int64).astype(np.uint64)) for s in rng.integers(low, high, n)]
    table = jaccard_join.bands(80)
    at = collections.Counter(int(np.searchsorted([b.lo for b in table], len(s), "right")) - 1 for s in sets)
    spare = [jaccard_join.spare_segments(b, at[i] + at[i + 1]) for i, b in enumerate(table)]
    seen = set()
    for i in range(0, n, 500):
        who, sig = jaccard_join.signatures(sets[i:i + 500], 80, spare)
        seen.update(zip(sig.tolist(), (who + i).tolist()))
    return sum(k * (k - 1) // 2 for k in collections.Counter(s for s, _ in seen).values())


@pytest.mark.parametrize("low, high", [(20, 40), (189, 300), (500, 720)])
def test_pairs_of_unrelated_sets_follow_their_number(low, high):
    few, many = _signature_pairs(700, low, high), _signature_pairs(7000, low, high)
    assert many <= 12 * max(few, 70), (few, many)


def test_spare_segments_grow_with_the_logarithm():
    wide = jaccard_join.band(718, 80)
    ks = [jaccard_join.spare_segments(wide, 10 ** e) for e in range(2, 12)]
    assert ks == sorted(ks) and ks[-1] - ks[0] < 60 and jaccard_join.spare_segments(wide, 0) == 0


def test_full_masks_and_long_texts_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = [f"w{x}" for x in rng.integers(0, 9000, 4000)]
    texts = [" ".join(base), " ".join(base[:3900]), " ".join(base[50:] + ["z"] * 9), " ".join(base[:2000]), " ".join(reversed(base)), "a b c d e f"]
    texts += [" ".join(f"v{x}" for x in rng.integers(0, 50, 30)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, root = _linked(texts, 4, 85)
    want = {i: min(j for j in range(len(texts)) if root[j] == root[i]) for i in range(len(texts))}
    assert want[1] == 0
    for bits, block in ((jaccard_join.MASK_BITS, jaccard_join.BLOCK_BYTES), (7, 1000)):
        monkeypatch.setattr(jaccard_join, "MASK_BITS", bits)
        monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", block)
        monkeypatch.setattr(jaccard_join, "HOT_PAIRS", 1 if bits == 7 else 256)
        got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(df).collect()}
        assert got == want
    monkeypatch.setattr(exact_dedup, "LENGTH_BITS", 6)
    monkeypatch.setattr(exact_dedup, "PREFIX_BITS", 6)
    again = df.unionByName(df.where("doc_id < 3").withColumn("doc_id", F.col("doc_id") + 100))
    kept = exact_dedup.exact_dedup(again).where("kept").select("doc_id")
    assert sorted(r[0] for r in kept.collect()) == sorted([*range(3, len(texts)), 100, 101, 102])


# -- the pipeline ---------------------------------------------------------------------------

def _survivors(docs):
    """Rows after language ID, exact and near dedup."""
    lettered = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    best = {}
    for d in lettered:
        if d[1] not in best or (d[0] is not None and (best[d[1]][0] is None or d[0] > best[d[1]][0])):
            best[d[1]] = d
    rows = list(best.values())
    _, root = _linked([d[1] for d in rows], 5, 80)
    out = []
    for r in set(root):
        own = [d for d, x in zip(rows, root) if x == r]
        named = [d for d in own if d[0] is not None]
        out += [d for d in own if d[0] is None] + ([min(named, key=lambda d: (d[0], _sha(d[1])))] if named else [])
    return out


def test_stages_one_after_the_other(spark, folder, docs):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        df = common.cut_lineage(stage(spark, df, folder))
        assert df.columns == COLUMNS
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(_survivors(docs), key=repr)
    mixed = common.cut_lineage(corpus_pipeline.mix_sources(spark, df, folder))
    assert mixed.columns == COLUMNS
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    per = collections.Counter()
    for r in mixed.collect():
        per[r.source] += size(r.text)
    plan = mixing.mix_plan(df.select("doc_id", "text", "source")).collect()
    target = {r.source: r.target for r in plan}
    assert all(abs(per[s] - t) <= max(size(d[1]) for d in docs) for s, t in target.items())
    pieces = corpus_pipeline.pack_sequences(spark, mixed, folder)
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    assert pieces.agg(F.sum("length")).first()[0] == sum(
        len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in mixed.collect())


def test_run_on_filled_and_empty_tables(spark, folder, empty_folder, docs):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} <= {d[0] for d in _survivors(docs)} and sum(r.length for r in rows) > 2000
    assert corpus_pipeline.run(spark, empty_folder).count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.read.parquet(f"{empty_folder}/documents.parquet"), empty_folder).count() == 0


# -- stores, frames -------------------------------------------------------------------------

def test_uris_of_stores(tmp_path, monkeypatch):
    fs, path = common.file_system(f"file:{tmp_path}")
    assert path == str(tmp_path) and fs.get_file_info(path).type.name == "Directory"
    assert common.file_system(f"file://{tmp_path}")[1] == str(tmp_path)
    seen = []

    class Store:
        @staticmethod
        def from_uri(uri):
            seen.append(uri)
            return None, ""

    monkeypatch.setattr(common.pafs, "FileSystem", Store)
    for uri in ("s3a://b/k", "S3A://b/k", "gcs://b/k", "wasbs://c@a/k", "hdfs://n:1/k", "viewfs://n/k", "abfss://c@a/k"):
        common.file_system(uri)
    assert seen == ["s3://b/k", "s3://b/k", "gs://b/k", "abfss://c@a/k", "hdfs://n:1/k", "viewfs://n/k", "abfss://c@a/k"]


def test_damaged_archives_are_told():
    import io

    import zstandard

    whole = warc.dictionary_frame(b"<html><body>" * 40) + zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(b"<html><body>" * 40)).compress(b"record")
    assert list(warc.frames(io.BytesIO(whole))) == [b"record"]
    for bad in (b"", whole[:5], whole[4:], whole[:30], whole[:-3], zstandard.ZstdCompressor().compress(b"no dictionary")):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.frames(io.BytesIO(bad)))


@pytest.mark.parametrize("candidates, queries_each, sent", [(16, 3, 1 << 27), (16, 8192, 0), (1 << 15, 8192, 1 << 27)])
def test_searching_fewer_blocks_gives_the_same(spark, monkeypatch, candidates, queries_each, sent):
    monkeypatch.setattr(topk, "CANDIDATES", candidates)
    monkeypatch.setattr(topk, "QUERIES", queries_each)
    monkeypatch.setattr(topk, "BOUND_BYTES", sent)
    rng = np.random.default_rng(9)
    rows = [(i, [int(x) for x in rng.integers(-9, 10, 4) * (1 + 20 * (i % 17 == 0))][:3 + i % 2]) for i in range(300)]
    rows += [(i, [1, 1, 1, 1]) for i in range(300, 340)] + [(340, [])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, v array<long>"), F.col("vec_id") % 20 == 0, 7).collect()
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    for q, v in rows:
        if q % 20 == 0:
            want = sorted((-score(v, w), i) for i, w in rows if i != q)[:7]
            assert sorted((r["rank"], -r.score, r.vec_id) for r in got if r.query_id == q) == [(k + 1, *x) for k, x in enumerate(want)]


def test_exact_dedup_of_one_row_without_end(spark):
    rows = [(7, "same text", "a")] * 5000 + [(7, "same text", "b"), (3, "same text", "c"), (8, "other", "d"), (None, "same text", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, note string").repartition(8)
    out = exact_dedup.exact_dedup(df)
    kept = out.where("kept").collect()
    assert out.count() == len(rows) and out.where("text = 'same text'").agg(F.max("group_size"), F.min("keep_id")).first()[:] == (5003, 7)
    want = min("ab", key=lambda n: hashlib.sha256(f'{{"doc_id":7,"text":"same text","note":"{n}"}}'.encode()).hexdigest())
    assert sorted((r.doc_id, r.note) for r in kept) == [(7, want), (8, "d")]
