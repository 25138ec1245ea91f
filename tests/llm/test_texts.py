"""Operators on texts against brute force, on a corpus with every special case."""
import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm import (byte_bpe, line_dedup, minhash_forest, mixing, quality, substring_dedup,
                            token_counts)
from ledgerflow.llm.fm_index import FmIndex
from ledgerflow.session import checkpoint_root

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# extra columns whose names the operators use inside
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("key", T.StringType()), T.StructField("size", T.StringType()),
    T.StructField("node", T.LongType()), T.StructField("h", T.LongType())])


def passage(rnd, n):
    return [f"{rnd.choice('abcdef')}{rnd.randint(0, 400)}" for _ in range(n)]


def corpus():
    """Documents with near and exact copies, shared passages, nulls, empty and very long texts,
    repeated ids and repeated rows."""
    rnd = random.Random(11)
    shared = [passage(rnd, n) for n in (60, 75, 130)]
    texts = []
    for i in range(40):
        words = passage(rnd, rnd.randint(1, 160))
        if i % 4 == 0:
            p = shared[i % 3]
            words[len(words) // 2:len(words) // 2] = p
        texts.append(" ".join(words))
    for i in (1, 2, 5):  # near copies with a few words changed
        for k in range(6):
            words = texts[i].split()
            for _ in range(k):
                words[rnd.randrange(len(words))] = f"z{rnd.randint(0, 99)}"
            texts.append(" ".join(words))
    texts += [texts[3], texts[3].upper(), "", None, " \t\n ", "one", "one two", "One  TWO", "Die " * 120,
              "Die " * 90 + "x", "héllo wörld\x0b漢字 😀 " * 3, "a\n\nb\r\n\n a ", "word " * 30000,
              "\n".join(["  Frequent LINE\t", "only here", "frequent line"]), "x" * 70000]
    texts += [f"frequent line\nbody {i}" for i in range(12)]
    rows = [(i * 3, t, "en", ("s%d" % (i % 5)) if i % 7 else None, None, i % 2, "k", "big", 5, i)
            for i, t in enumerate(texts)]
    rows.append((None, texts[3], None, None, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None, None))
    rows.append(rows[4])
    rows.append(rows[2][:1] + (texts[7],) + rows[2][2:])  # an id with a second text
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def multiset(rows):
    return Counter(tuple(r) for r in rows)


# ---- byte-level BPE

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def test_bpe_equals_library_and_round_trips(docs, empty):
    enc = byte_bpe.encoding(RANKS, PATTERN)
    want = []
    for d, t in rows_of(docs):
        ids = np.array(enc.encode_ordinary(t or ""), dtype="<u4")
        want.append((d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    for size in (7, byte_bpe.SPLIT_CHARS):
        got = byte_bpe.round_trip(docs, RANKS, PATTERN, split_chars=size).collect()
        assert multiset(got) == multiset(want)
    tokens = byte_bpe.encode(docs, RANKS, PATTERN)
    data = byte_bpe.decode(tokens, RANKS, PATTERN)
    assert multiset((r.doc_id, bytes(r.data)) for r in data.collect()) == multiset(
        (d, (t or "").encode()) for d, t in rows_of(docs))
    assert byte_bpe.round_trip(empty, RANKS, PATTERN, with_ids=True).count() == 0


def test_bpe_refuses_patterns_that_match_across_cuts(docs):
    byte_bpe.check_pattern(PATTERN)
    for pattern in (r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+", r" ?[^\s\p{L}\p{N}]+[\r\n]*|\s*\p{L}+|\p{N}+|\s+", r"\S+\s*"):
        with pytest.raises(ValueError, match="across"):
            byte_bpe.encode(docs, RANKS, pattern)


def test_bpe_safe_parts_on_odd_texts():
    enc, rnd = byte_bpe.encoding(RANKS, PATTERN), random.Random(4)
    for _ in range(400):
        t = "".join(rnd.choice(" \n\t'sla1é漢😀.x") for _ in range(rnd.randint(0, 80)))
        assert "".join(byte_bpe.safe_parts(t, 5)) == t
        assert byte_bpe.encode_text(enc, t, 5).tolist() == enc.encode_ordinary(t)


# ---- token counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_token_counts_equal_library(docs, empty):
    c = token_counts.counter(MODEL)
    assert c.plain  # the chunked way is in use
    want = multiset((d, len((t or "").encode()), len(c.whole.encode(t or ""))) for d, t in rows_of(docs))
    for chunk, overlap in ((token_counts.CHUNK_CHARS, token_counts.OVERLAP_CHARS), (60, 8)):
        got = token_counts.count_tokens(docs, MODEL, chunk_chars=chunk, overlap_chars=overlap)
        assert multiset(got.collect()) == want
    assert token_counts.count_tokens(empty, MODEL).count() == 0


def test_token_chunks_on_odd_texts():
    c, rnd = token_counts.counter(MODEL), random.Random(5)
    odd = ["".join(rnd.choice(" ▁\nab<s>1é漢😀\t0x") for _ in range(rnd.randint(0, 60)))
           for _ in range(400)] + ["a" * 500, " " * 300, "▁ x", "<s></s><unk><0x0A>"]
    for chunk, overlap in ((32768, 256), (20, 4), (7, 2)):
        assert [c.count(t, chunk, overlap) for t in odd] == [len(c.whole.encode(t)) for t in odd]


# ---- line dedup

def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def lines_brute(pairs, min_docs):
    found = defaultdict(set)
    for d, t in pairs:
        for line in (t or "").split("\n"):
            if key(line):
                found[key(line)].add(d)
    out = []
    for d, t in pairs:
        parts = (t or "").split("\n")
        kept = [x for x in parts if len(found.get(key(x), ())) < min_docs]
        out.append((d, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return multiset(out)


@pytest.mark.parametrize("min_docs", [2, 10])
def test_line_dedup_against_brute_force(docs, min_docs):
    out = line_dedup.dedup_lines(docs, min_docs=min_docs)
    assert out.columns[:len(docs.columns)] == docs.columns
    got = out.select("doc_id", "text", "_llm_lines", "_llm_dropped").collect()
    assert multiset(got) == lines_brute(rows_of(docs), min_docs)


def test_line_dedup_empty(empty):
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_writes_no_tables_and_reads_its_exchanges_again(spark, tmp_path):
    root = checkpoint_root(spark)
    docs = spark.createDataFrame([(i, f"often\nbody {i}") for i in range(30)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    before = set(os.listdir(root))
    out = line_dedup.dedup_lines(spark.read.parquet(str(tmp_path / "docs")))
    assert multiset(out.collect()) == multiset((i, f"body {i}", 2, 1) for i in range(30))
    assert set(os.listdir(root)) == before
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("MapInArrow") == 2  # one pass makes the digests, one drops the lines


def test_line_count(docs, empty):
    rows = rows_of(docs)
    assert line_dedup.line_count(docs) == sum((t or "").count("\n") + 1 for _, t in rows)
    assert line_dedup.line_count(docs.select(F.col("text").cast("binary").alias("t")), "t") == line_dedup.line_count(docs)
    assert line_dedup.line_count(empty) == 0


def test_line_dedup_is_reversible(spark, docs):
    one = docs.where("doc_id % 2 = 0 OR doc_id IS NULL")
    two = docs.where("doc_id % 2 = 1")
    l1, l2 = line_dedup.line_digests(one), line_dedup.line_digests(two)
    refs1 = line_dedup.references(l1)
    shards = 4
    f1 = line_dedup.build_filters(refs1, shards, 2)
    both = line_dedup.insert_documents(refs1, l2)
    f2 = line_dedup.update_filters(f1, refs1, both, shards, 2)
    keys = line_dedup.references(line_dedup.line_digests(docs)).select("key")

    def frequent(refs, filters):
        return {bytes(r.key) for r in
                line_dedup.frequent_lines(keys, refs, filters, shards, 2).collect()}

    def exact(refs):
        return {bytes(r.key) for r in refs.where("refs >= 2").collect()}

    whole = line_dedup.references(line_dedup.line_digests(docs))
    assert multiset(both.collect()) == multiset(whole.select("key", "refs").collect())
    assert frequent(both, f2) == exact(whole)
    back = line_dedup.delete_documents(both, l2)
    f3 = line_dedup.update_filters(f2, both, back, shards, 2)
    assert multiset(back.collect()) == multiset(refs1.collect())
    assert frequent(back, f3) == exact(refs1)


def test_cuckoo_filter_insert_delete():
    digests = [line_dedup.digest(str(i).encode()) for i in range(3000)]
    f = line_dedup.CuckooFilter.of(digests[:2000])
    assert f.contains(digests[:2000]).all()
    assert f.contains(digests[2000:]).mean() < 0.02
    f.delete(digests[:1000])
    assert f.contains(digests[1000:2000]).all()
    assert f.contains(digests[:1000]).mean() < 0.02


# ---- MinHash

def shingle_set(t):
    w = WORD.findall((t or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def near_brute(pairs):
    sets = [(d, shingle_set(t)) for d, t in pairs]
    parent = {d: d for d, _ in pairs if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    live = [(d, s) for d, s in sets if d is not None and s]
    for i, (a, s) in enumerate(live):
        for b, t in live[i + 1:]:
            if 100 * len(s & t) >= 75 * len(s | t):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return multiset((d, len(s), None if d is None else root(d), d is None or root(d) == d)
                    for d, s in sets)


def test_minhash_against_brute_force(docs, empty):
    got = minhash_forest.near_duplicates(docs)
    assert multiset(got.collect()) == near_brute(rows_of(docs))
    assert minhash_forest.near_duplicates(empty).count() == 0


def test_minhash_crowded_regions(spark):
    """Many variants of one text: more in a region than a leaf holds, and a chain in which only
    neighbours link."""
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for p in rnd.sample(range(120), rnd.choice([1, 2, 6, 9])):
            words[p] = f"v{rnd.randint(0, 50)}"
        rows.append((i, " ".join(words)))
    chain = [f"c{i}" for i in range(200)]
    rows += [(1000 + i, " ".join(chain[i * 5:i * 5 + 60])) for i in range(28)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert multiset(minhash_forest.near_duplicates(df).collect()) == near_brute(rows)


def test_minhash_template_against_sql(spark):
    """Pages of one template, all 0.70 to 0.74 similar to each other, with some pairs at 0.76: far more
    in a region than a leaf holds, and no text in the middle that they link with."""
    import duckdb
    import pandas as pd

    from ledgerflow.llm.queries import OP6_SQL
    rnd = random.Random(4)
    template = [f"t{i}" for i in range(500)]

    def page(*own):
        words = list(template)
        words[200:200 + sum(map(len, own))] = [w for part in own for w in part]
        return " ".join(words)

    def fresh(count):
        return [f"u{rnd.getrandbits(60)}" for _ in range(count)]

    texts = []
    for i in range(300):  # all have the slot's 72 to 83 words of their own
        texts.append(page(fresh(rnd.randint(72, 83))))
    for i in range(40):   # two that share the first 15 of 78 words
        shared = fresh(15)
        texts += [page(shared, fresh(63)) for _ in range(2)]
    rnd.shuffle(texts)
    sets = [shingle_set(t) for t in texts]
    near = [len(s & t) / len(s | t) for i, s in enumerate(sets) for t in sets[i + 1:]]
    assert all(0.7 <= x < 0.75 or 0.755 < x < 0.77 for x in near) and sum(x > 0.75 for x in near) == 40
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    with duckdb.connect() as sql:
        sql.register("documents", documents)
        want = multiset(sql.execute(OP6_SQL).fetchall())
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert multiset(minhash_forest.near_duplicates(df).collect()) == want


def test_minhash_text_ids(docs):
    """Ids of another type give the same groups, named by their smallest id in text order."""
    as_text = docs.where("doc_id IS NOT NULL").withColumn("doc_id", F.format_string("d%05d", "doc_id"))
    want = [(f"d{d:05d}", n, f"d{c:05d}", k) for d, n, c, k in near_brute(rows_of(docs)).elements()
            if d is not None]
    assert sorted(map(tuple, minhash_forest.near_duplicates(as_text).collect())) == sorted(want)


def test_forest_orders_are_cut_at_short_prefixes():
    rnd = np.random.default_rng(3)
    keys = rnd.integers(0, 3, (4000, minhash_forest.HASHES)).astype("i4")
    keys[:300] = keys[0]
    keys = keys[np.lexsort(keys.T[::-1])]
    prefix = minhash_forest.common_prefix(keys)
    brute = [next((p for p, (x, y) in enumerate(zip(a, b)) if x != y), len(a)) for a, b in zip(keys, keys[1:])]
    assert prefix.tolist() == brute
    starts = minhash_forest.cut(prefix, 16)
    ends = np.append(starts[1:], len(keys))
    assert starts[0] == 0 and (ends - starts).max() <= 16 and (ends > starts).all()
    for lo, hi in zip(starts[1:], ends[1:]):  # no run could have been joined with the one before it at its depth
        edge = prefix[lo - 1]
        wide = lo - 1
        while wide and prefix[wide - 1] >= edge:
            wide -= 1
        end = lo
        while end < len(prefix) and prefix[end] >= edge:
            end += 1
        assert end - wide + 1 > 16
    assert minhash_forest.cut(np.array([], dtype=int), 16).tolist() == [0]


def test_keep_one(docs):
    out = minhash_forest.keep_one(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert ids.count(None) == 2
    want = {d for d, _, c, k in near_brute(rows_of(docs)) if k and d is not None}
    assert sorted(i for i in ids if i is not None) == sorted(want)


# ---- mixing

def mixing_brute(pairs, weights=(5, 2, 1)):
    size = {s: 0 for s, _ in pairs}
    for s, n in pairs:
        size[s] += n
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(order)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > 2 * size[s]}
        if not over:
            target.update({s: level * w[s] for s in open_})
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
        open_ -= over
    return size, target


def test_mixing_targets_and_copies(docs, empty):
    src = [(r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()]
    size, target = mixing_brute(src)
    rated = mixing.rate_documents(docs.select("doc_id", "text", "source"))
    again = mixing.rate_documents(docs.select("doc_id", "text", "source").repartition(5))
    got = rated.collect()
    assert multiset(got) == multiset(again.collect())
    by_id = {(r.doc_id, r.text): r.source for r in docs.collect()}
    assert len(got) == len(src) and by_id
    assert sorted((r.source_size, round(r.target, 6)) for r in got) == sorted(
        (size[s], round(target[s], 6)) for s, _ in src)
    for r in got:
        rate = r.target / r.source_size if r.source_size else 0
        assert r.n_copies in (int(rate), int(rate) + 1) and r.n_copies <= 2
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.n_copies for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.rate_documents(empty).count() == 0


def test_mixing_comes_near_targets(spark):
    df = spark.range(30000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 9 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"))
    per = (mixing.rate_documents(df).join(df.select("doc_id", "source"), "doc_id").groupBy("source")
           .agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("n_copies")).alias("got")))
    for r in per.collect():
        assert abs(r.got - r.t) <= 0.05 * r.t


# ---- quality

def test_quality_scores_every_row(spark, docs, empty):
    labels = docs.select("doc_id", (F.length("text") > 200).cast("int").alias("quality"))
    model = quality.train(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 for r in got)
    want = [(d, float(model.scores(np.array([quality.features((t or "").encode())]))[0]))
            for d, t in rows_of(docs)]
    assert multiset((r.doc_id, round(r.score, 9)) for r in got) == multiset(
        (d, round(s, 9)) for d, s in want)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(s >= 0.5 for _, s in want)
    assert quality.score(empty, model).count() == 0
    none = quality.train(empty, labels.limit(0))
    assert [r.score for r in quality.score(docs.limit(1), none).collect()] == [0.5]


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(d, labels)
    held = labels.where(quality.is_held_out(F.col("doc_id")))
    seen = quality.score(d, model).join(held, "doc_id").select(
        ((F.col("score") >= 0.5).cast("int") == F.col("quality")).alias("ok"), "doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in seen)
    assert len(seen) > 500 and sum(r.ok for r in seen) / len(seen) >= 0.97


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:2000], y[:2000])
    assert ((model.scores(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.9


# ---- substring dedup

def repeats_brute(pairs, window):
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t in pairs]
    for d, w in split:
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in split:
        gone = set()
        if d is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i:i + window])] < d:
                    gone.update(range(i, i + window))
        out.append((d, " ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return multiset(out)


@pytest.mark.parametrize("window,gram", [(50, 16), (12, 4)])
def test_substring_dedup_against_brute_force(docs, window, gram):
    small = docs.where("text IS NULL OR length(text) < 20000")
    got = substring_dedup.remove_repeats(small, window=window, gram=gram)
    assert multiset(got.collect()) == repeats_brute(rows_of(small), window)


def test_substring_dedup_empty_and_long(docs, empty):
    assert substring_dedup.remove_repeats(empty).count() == 0
    long = docs.where("length(text) >= 20000")
    assert multiset(substring_dedup.remove_repeats(long).collect()) == repeats_brute(rows_of(long), 50)


def test_fm_index_matching_statistics():
    rng = np.random.default_rng(0)
    for _ in range(40):
        symbols, window = rng.integers(1, 6), int(rng.integers(1, 6))
        pieces = [rng.integers(0, symbols, rng.integers(0, 30)).astype("u8")
                  for _ in range(rng.integers(1, 6))]
        ids = [int(x) for x in rng.integers(0, 50, len(pieces))]
        index = FmIndex.load(FmIndex.build(pieces, ids, window).dump())
        texts = [rng.integers(0, symbols + 1, rng.integers(0, 25)).astype("u8") for _ in range(8)]
        got, want = {}, {}
        index.search(texts, lambda n, p, d: got.update(
            {(int(a), int(b)): int(c) for a, b, c in zip(n, p, d)}))
        for i, t in enumerate(texts):
            for s in range(len(t) - window + 1):
                w = t[s:s + window].tolist()
                low = [d for p, d in zip(pieces, ids) for k in range(len(p) - window + 1)
                       if p[k:k + window].tolist() == w]
                if low:
                    want[i, s] = min(low)
        assert got == want
