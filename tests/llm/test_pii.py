"""Personal data: base patterns against Python's matcher, and what bootstrapping adds."""
import random
import re
from collections import Counter, defaultdict

from ledgerflow.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")),
            "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p) in enumerate(BASE.items())
             for m in re.finditer(p, text or "") if good(k, m.group())]
    return [x[2] for x in sorted(found)]


def texts():
    rnd = random.Random(8)
    out = ["".join(rnd.choice("a1@.-+ ()%_x9\n") for _ in range(rnd.randint(0, 90))) for _ in range(200)]
    out += ["".join(rnd.choice("1234567890 -.") for _ in range(70)) for _ in range(60)]
    out += ["".join(rnd.choice("ab@.-") for _ in range(50)) for _ in range(60)]
    out += ["", None, "no digits at all", "mail a@b.co and 4111 1111 1111 1111 or +1 (269) 555-3296",
            "é漢😀 10.0.0.1 😀 1.2.3.999 0000001.2.3.4", "1 " * 20000, "a@" * 20000, "x" * 90000 + "1"]
    return out


def test_base_spans(spark):
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts())] + [(None, "z@y.org", "x", 1, 2)]
    rows.append(rows[-5])
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string, s int, i int").repartition(3)
    got = Counter(tuple(r) for r in pii.spans_per_document(df).collect())
    want = Counter()
    for r in rows:
        b = brute(r[1])
        n = Counter(x.split(":")[0] for x in b)
        want[(r[0], *[n[k] for k in pii.KINDS], ",".join(b), ",".join(b))] += 1
    assert got == want
    assert pii.spans_per_document(df.limit(0)).count() == 0


def test_bootstrapping_discovers_unseen_identifiers(spark):
    """``Tel:`` stands before many phones, so a number that the base pattern misses is found after
    it; a word that stands before all kinds teaches nothing, nor do copies of one document."""
    rnd = random.Random(9)
    rows = []
    for i in range(20):
        num = f"+1 269 555 {rnd.randint(1000, 9999)}"
        rows.append((i, f"reach us Tel: {num} the u{i}@x.org and the 10.0.{i}.1 of the {num}9"))
    rows.append((100, "only here Tel: 030-5551234 and the 030-5559999"))
    rows += [(200 + i, "copy Fax: +1 269 555 0000 end") for i in range(30)]
    rows.append((300, "Fax: 030-5551234"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in pii.spans_per_document(df).collect()}
    assert got[100].spans == "phone:15:26" and got[100].base == "" and got[100].n_phone == 0
    assert got[300].spans == ""
    for i, t in rows[:20]:
        assert got[i].spans == got[i].base == ",".join(brute(t))


def test_bootstrapping_with_punctuation_and_blanks(spark):
    """Numbers at a sentence end, in brackets or written with blanks are found without what is around
    them, and do not lower the score of the word before them."""
    rnd = random.Random(10)
    rows = [(i, f"Tel: +1 269 555 {rnd.randint(1000, 9999)} the") for i in range(100)]
    rows += [(200 + i, f"Tel: 030-555{i:04d}.") for i in range(30)]
    odd = ["Tel: 030-5551234.", "Tel: 030-5551234,", "Tel: (030-5551234)", "Tel: 030 555 1234 end",
           "Tel: 030 555 1234.", "Tel: (030)555-1234 x", "Tel: 030-5551234 20 pieces", "Tel: 030-5551234"]
    want = ["5:16", "5:16", "6:17", "5:17", "5:17", "5:18", "5:16", "5:16"]
    rows += [(300 + i, t) for i, t in enumerate(odd)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.spans for r in pii.spans_per_document(df).collect()}
    assert [got[300 + i] for i in range(len(odd))] == [f"phone:{w}" for w in want]
    assert all(got[200 + i] == "phone:5:16" for i in range(30))


def plain_bootstrap(rows, rounds=4, least=8, high=0.9):
    """Scores over sets of words, one identifier a text: (left words, identifier, kind or None, right words)."""
    def general(w):
        return re.sub("[0-9]+", "0", w.lower())

    edges = defaultdict(dict)
    for left, m, kind, right in rows:
        words = [general(w) for w in left.split()]
        after = general(right.split()[0]) if right.split() else ""
        contexts = []
        if words:
            contexts += [("left", words[-1])] + [("two", *words[-2:])] * (len(words) > 1)
        if after:
            contexts.append(("right", after))
            if words:
                contexts.append(("both", words[-1], after))
        for c in contexts:
            edges[c][m] = kind
    score = {}
    fits = {k: re.compile(p) for k, p in pii.SHAPES.items()}
    for r in range(rounds + 1):
        weight = defaultdict(float)
        for (c, k), x in score.items():
            for m, own in edges[c].items():
                if own is None and fits[k].search(m):
                    weight[m, k] = max(weight[m, k], x)
        score = {}
        for c, ms in edges.items():
            for k in pii.KINDS:
                seeds = sum(own == k for own in ms.values())
                ws = [weight[m, k] for m, own in ms.items() if own is None and fits[k].search(m)]
                sure = [w for w in ws if w >= high]
                if seeds >= least:
                    score[c, k] = (seeds + sum(ws)) / len(ms)
                elif r and seeds + len(sure) >= least:
                    score[c, k] = (seeds + sum(sure)) / len(ms)
    found = set()
    for (c, k), x in score.items():
        if x >= high:
            found |= {(m, k) for m, own in edges[c].items() if own is None and fits[k].search(m)}
    return found


def test_finds_induce_patterns_that_find_more(spark):
    """Numbers after ``Tel:`` are finds of the first rounds; the word on their right is learnt from them
    and finds numbers that stand after other words. Decoys after untrusted words are left alone."""
    rnd = random.Random(12)
    parts = [("Tel:", f"+1 269 555 {1000 + i}", "phone", f"w{chr(97 + i % 26)}x") for i in range(150)]
    parts += [("Tel:", f"030-555{i:04d}", None, "durchwahl") for i in range(80)]
    parts += [(f"v{chr(97 + i)}y", f"0441-77{i:04d}", None, "durchwahl") for i in range(4)]
    parts += [("order", f"4111-1111-{i:04d}", None, "shipped") for i in range(30)]
    parts += [("the", f"10.0.0.{i}", "ip", "host") for i in range(20)]
    parts += [("the", f"u{i}@x.org", "email", "host") for i in range(20)]
    parts += [("the", "1.2.3", None, "host"), ("see", "room 12", None, "x")]
    rnd.shuffle(parts)
    rows = [(i, f"{left} {m} {right}") for i, (left, m, _, right) in enumerate(parts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = set()
    for r in pii.spans_per_document(df).collect():
        base, text = set(r.base.split(",")), rows[r.doc_id][1]
        for span in filter(None, r.spans.split(",")):
            if span not in base:
                kind, s, e = span.split(":")
                got.add((text[int(s):int(e)], kind))
    want = plain_bootstrap([(left, m, k, right) for left, m, k, right in parts if m != "room 12"])
    assert got == want
    assert {(f"0441-77{i:04d}", "phone") for i in range(4)} <= got
    assert not any(m.startswith("4111-") for m, _ in got) and ("1.2.3", "ip") not in got
