"""Merkle manifest against a plain tree, and the registered query's columns."""
import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerflow.llm import merkle, queries

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, g string, pos long, "
          "digest string, block long, node string, path string, n long, id string, top string, root string")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, low=False):
    text = r[1] if not low or r[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
    values = [r[0], r[3], r[2], r[4], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def climb(tree, at, digest):
    """The siblings of a node on its way up, and what a digest in its place folds to."""
    siblings = ""
    for level in tree[:-1]:
        run = level[at // 16 * 16:at // 16 * 16 + 16]
        left, right = "".join(run[:at % 16]), "".join(run[at % 16 + 1:])
        siblings, digest, at = siblings + left + right, sha(left + digest + right), at // 16
    return siblings, digest


def brute(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees, members = {}, {}
    for s, rs in by_source.items():
        members[s] = sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in members[s]])
    top = levels([trees[s][-1][0] for s in order])
    root = top[-1][0]
    out = Counter()
    for k, s in enumerate(order):
        for i, r in enumerate(members[s]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            a, d = climb(trees[s], i, leaf(r, bad))
            b, d = climb(top, k, d)
            out[(r[0], leaf(r), trees[s][-1][0], root, sha(a + b), d, d == root)] += 1
    return out


def rows():
    extra = ("x", 1, "y", 2, "z", "p", 3, "i", "t", "r")

    def row(i, text, source, lang="en", n=None):
        return (i, text, lang, source, n, *extra)
    out = [row(i, f"Text {i}", "hot", n=i) for i in range(4400)]
    out += [row(i, f"TEXT {i}", f"s{i % 40}") for i in range(300)]
    out += [row(i, "Été\nAZ", None) for i in range(17)] + [row(i, "a", "") for i in range(16)]
    out += [row(-7, None, "ß"), row(None, "No Id", "hot"), row(None, None, None, None), row(10, "Z" * 90000, "big"),
            row(5, "same", "twins"), row(5, "same", "twins"), row(5, "other", "twins"), row(10, "", "empty")]
    return out


def test_query_equals_plain_tree(spark, scratch):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    df.write.parquet(f"{scratch}/documents.parquet")
    got = queries.REGISTRY["op11_merkle"](spark, scratch)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r) for r in got.collect()) == brute(data)


def test_small_tables(spark):
    df = spark.createDataFrame(rows()[:1], SCHEMA)
    assert merkle.manifest(df.limit(0)).count() == 0
    one = merkle.manifest(df).collect()[0]
    assert one.leaf == one.subroot == one.root and one.path == []


def test_tampering_with_any_field_is_seen(spark):
    df = spark.createDataFrame(rows()[:40], SCHEMA)
    other = [F.col(c) if c != "lang" else F.lit(None) for c in merkle.FIELDS]
    rows_ = merkle.manifest(df, carry={"other": merkle.leaf(other)})
    rows_ = rows_.select((merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"),
                         (merkle.folded(F.col("other"), F.col("path")) == F.col("root")).alias("bad"))
    assert {tuple(r) for r in rows_.collect()} == {(True, False)}
