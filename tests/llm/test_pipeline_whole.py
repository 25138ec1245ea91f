"""The pipeline's rows against the same five stages in plain Python, and the classifier's features against
their definitions."""
import base64
import bisect
import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from ledgerflow.llm import quality
from ledgerflow.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text):
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return [0.0] * len(quality.FEATURES)
    n, lines, kinds = len(words), data.split(b"\n"), Counter(words)

    def share(pattern):
        return len(re.findall(pattern, data)) / len(data)

    pairs = [(words[i], words[i + 1]) for i in range(n - 1)]
    return [math.log(1 + n), sum(len(w) for w in words) / n, share(rb"[A-Z]"), share(rb"[0-9]"), share(rb"[.,;:]"),
            share(rb"[!?]"), share(rb"\|"), share(rb"[#$%&*@~^+=<>{}\[\]\\_]"), share(rb"[\"'()\-/`]"),
            share(rb"[\x80-\xff]"), len(lines) / n, sum(len(w) > 14 for w in words) / n,
            sum(len(w) < 4 for w in words) / n, len(kinds) / n, len(set(pairs)) / n, kinds.most_common(1)[0][1] / n,
            sum(a == b for a, b in pairs) / n, len(set(lines)) / len(lines), math.log(1 + len(data) / len(lines)),
            sum(w[-1:] in (b"!", b"#", b"$", b"%", b"&", b"*", b"|") for w in kinds) / len(kinds)]


def plain_score(model, x):
    total = model.intercept
    for value, cuts, own in zip(x, model.cuts, model.tables):
        total += own[bisect.bisect_right(list(cuts), value)]
    for i, j, ci, cj, own in model.pairs:
        total += own[bisect.bisect_right(list(ci), x[i])][bisect.bisect_right(list(cj), x[j])]
    return 1 / (1 + math.exp(-total))


def without_lines(rows):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = defaultdict(set)
    for i, text, _ in rows:
        for line in (text or "").split("\n"):
            if key(line):
                holders[key(line)].add(i)
    return [(i, "\n".join(x for x in (text or "").split("\n") if len(holders.get(key(x), ())) < 10), s)
            for i, text, s in rows]


def without_copies(rows):
    def shingles(text):
        w = WORD.findall(text.translate(LOWER))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [(i, shingles(text)) for i, text, _ in rows if i is not None]
    group = {i: i for i, _ in sets}
    for n, (a, x) in enumerate(sets):
        for b, y in sets[n + 1:]:
            if x and y and 4 * len(x & y) >= 3 * len(x | y):
                low, high = sorted((group[a], group[b]))
                group = {k: low if v == high else v for k, v in group.items()}
    return [r for r in rows if r[0] is None or group[r[0]] == r[0]]


def mixed(rows):
    size = Counter()
    for _, text, s in rows:
        size[s] += len(WORD.findall(text))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, fluid, rate = 1.5 * sum(size.values()), set(order), {}
    while True:
        level = left / sum(weight[s] for s in fluid)
        full = {s for s in fluid if level * weight[s] > 2 * size[s]}
        if not full:
            break
        fluid -= full
        left -= sum(2 * size[s] for s in full)
        rate.update(dict.fromkeys(full, 2.0))
    rate.update({s: level * weight[s] / size[s] for s in fluid if size[s]})
    rate.update({s: 0.0 for s in size if not size[s]})  # a source without words is not taken
    out = []
    for i, text, s in rows:
        draw = int(hashlib.md5(f"17:{'null' if i is None else i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        out += [(i, text)] * (int(rate[s]) + (draw < rate[s] - int(rate[s])))
    return out


def encoded(rows):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for i, text in rows:
        ids = library.encode_ordinary(text)
        out.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                    hashlib.sha256(text.encode()).hexdigest(), tuple(ids)))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean and noisy documents of four sources, one null and one without words, with common lines, copies, near copies, a
    text of line feeds, a null id and a null text."""
    root, rnd = str(tmp_path_factory.mktemp("pipeline")), random.Random(12)
    words = ["river", "mountain", "Evening", "quiet", "harvest", "letter", "window", "garden", "summer", "bridge", "naïve",
             "written", "between", "station", "morning,", "because"]
    rows, labels = [], []
    for i in range(150):
        noisy = i % 3 == 0
        if noisy:
            text = " ".join(rnd.choice(["!!!", "$$$", "BUY", "|", "click#", "1%"]) for _ in range(rnd.randint(20, 60)))
        else:
            text = "\n".join(" ".join(rnd.choice(words) for _ in range(rnd.randint(6, 12))) + "." for _ in range(rnd.randint(3, 8)))
            text += "\n  Read more on the next page \n" if i % 4 else ""
        rows.append((i, text, "en", (None, "books", "forum")[i * i % 7 % 3], len(text)))
        labels.append((i, int(not noisy), 0))
    good = [r for r in rows if r[0] % 3]
    for n, r in enumerate(good[:25]):
        w = r[1].split(" ")
        if n % 2:
            w[n % len(w)] = "changed"
        rows.append((200 + n, " ".join(w), "en", r[3], len(r[1])))
    rows += [(300, "\n\n", "en", "web", 2), (301, None, None, "books", None), (None, good[3][1] + " nameless", "en", "forum", 9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(
        f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{root}/labels.parquet")
    return root, [(r[0], r[1], r[3]) for r in rows]


def test_features(folder):
    for text in [t for _, t, _ in folder[1]] + ["", " \n", "é", "a", "x|y ! {z}\\ \"q\"\n\n\t(7) antidisestablishment a a"]:
        assert quality.features((text or "").encode()) == pytest.approx(plain_features(text), abs=1e-12)


def test_pipeline_against_plain_stages(spark, folder):
    root, rows = folder
    model = quality.train(table(spark, root, "documents"), table(spark, root, "labels"))
    good = [r for r in rows if plain_score(model, plain_features(r[1])) >= 0.5]
    lines = without_lines(good)
    alone = without_copies(lines)
    want = encoded(mixed(alone))
    assert len(rows) > len(good) > len(alone) and any(a[1] != (b[1] or "") for a, b in zip(lines, good))
    assert len({r[0] for r in want}) < len(want)
    out = corpus_pipeline.run(spark, root)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in out.collect()]
    assert Counter(got) == Counter(want)
