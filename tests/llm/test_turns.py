"""Conversation repair against trying all edits, and against whole strings on long conversations."""
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

from ledgerflow.llm import queries, turns

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = ("conv_id long, turn long, role string, text string, key string, gone string, fault string, _mark int, "
          "_nth int, has_turn int, _d int, _copy int")
EXTRA = ("k", "g", "f", 1, 2, 3, 4, 5)
FULL = {"u": "user", "a": "assistant"}


def spoil(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if d == 4 else role
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out[c] += [(t, role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    for rs in out.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else
                   "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_edits(rows, flags):
    """The cheapest of all edits, by trying each."""
    def options(row, flag):
        own = [("D", 2, [])]
        stay = 5 if flag == "truncated" else 0
        if flag not in ("blank", "duplicate"):
            own += [("K", stay, [row[1:]])] + [("R", 1 + stay, [(r, row[2])]) for r in FULL.values()]
        for n in range(3):
            for ins in itertools.product(FULL.values(), repeat=n):
                yield from (("I" * n + e, 5 * n + c, [(r, "") for r in ins] + x) for e, c, x in own)
    found = []
    per_row = [list(options(r, f)) for r, f in zip(rows, flags)]
    ends = [("I" * n, 5 * n, [(r, "") for r in ins]) for n in range(3) for ins in itertools.product(FULL.values(), repeat=n)]
    for choice in itertools.product(*per_row, ends):
        kept = [x for _, _, xs in choice for x in xs]
        if LEGAL.fullmatch("".join(r[:1] or "-" for r, _ in kept)):
            found.append((sum(c for _, c, _ in choice), "".join(e for e, _, _ in choice), kept))
    return min(found, key=lambda x: x[:2])


def by_strings(rows, flags):
    """The cheapest edits with whole letter strings in place of ranks, and nothing left out."""
    best = {0: (0, "", ())}
    for row, flag in [*zip(rows, flags), (None, None)]:
        new = {}
        for s, (c, audit, kept) in best.items():
            for k in range(3):
                if row is None:
                    moves = [("", s, 0, ())]
                else:
                    stay = 5 if flag == "truncated" else 0
                    moves = [("D", s, 2, ())]
                    if flag not in ("blank", "duplicate"):
                        to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((s, row[1][:1]))
                        if to is not None:
                            moves.append(("K", to, stay, (row[1:],)))
                        moves.append(("R", 3 if s == 2 else 2, 1 + stay, (("assistant" if s == 2 else "user", row[2]),)))
                for e, to, cost, x in moves:
                    found = (c + cost, audit + e, kept + x)
                    if to not in new or found[:2] < new[to][:2]:
                        new[to] = found
                kept += (("assistant" if s == 2 else "user", ""),)
                s, c, audit = 3 if s == 2 else 2, c + 5, audit + "I"
        best = new
    return min((v for s, v in best.items() if s in (0, 3)), key=lambda v: v[:2])


def report(conv, rows, solve):
    if not rows:
        return (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    flags = faults(rows)
    cost, audit, kept = solve(rows, flags)
    ts = {r[0] for r in rows} - {None}
    gaps = max(ts) - min(ts) + 1 - len(ts) if ts else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in kept)
    return (conv, gaps, *(flags.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def random_rows(rnd, conv, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "uncle"]
    texts = ["Yes.", "No!", "And then", "", " \n", None, "Été? \t", "x" * 50 + "."]
    alternate = rnd.random() < 0.5
    return [(conv, rnd.choice([i, i, i, i + 3, None]), roles[i % 2] if alternate and rnd.random() < 0.8 else
             rnd.choice(roles), f"{i} {rnd.choice(texts)}" if rnd.random() < 0.7 else rnd.choice(texts)) for i in range(n)]


def run(spark, scratch, rows):
    spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(5).write.parquet(
        f"{scratch}/conversations.parquet")
    got = queries.REGISTRY["op12_turns"](spark, scratch)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_query_equals_all_edits(spark, scratch):
    rnd = random.Random(3)
    rows = [r for c in range(90) for r in random_rows(rnd, c, rnd.randint(1, 3))]
    rows += [r for c in range(200, 320) for r in random_rows(rnd, c, 1)] + random_rows(rnd, None, 3)
    spoilt = spoil(rows)
    assert any(not rs for rs in spoilt.values())
    want = [report(c, [r for r in rs], all_edits) for c, rs in spoilt.items() if len(rs) <= 3]
    long = {c for c, rs in spoilt.items() if len(rs) > 3}
    got = [r for r in run(spark, scratch, rows) if r[0] not in long]
    assert got == sorted(want, key=repr)


def test_long_conversations_equal_whole_strings(spark, scratch, monkeypatch):
    """Conversations over many batches and spools; every row of one turn; one with hardly a legal row."""
    rnd = random.Random(5)
    rows = [r for c in range(40) for r in random_rows(rnd, c, rnd.randint(5, 60))]
    rows += [(90, i, "user", f"{i}." + "y" * 300 + ".") for i in range(900)]
    rows += [(91, 7, rnd.choice(["user", "assistant"]), f"{i}.") for i in range(300)]
    rows += [(92, i, ["user", "assistant"][i % 2], "z" * 400000 + f"{i}.") for i in range(60)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        got = run(spark, scratch, rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == sorted((report(c, rs, by_strings) for c, rs in spoil(rows).items()), key=repr)


def test_repaired_turns(spark):
    rows = random_rows(random.Random(9), 1, 30) + [(2, 0, "user", "Hi."), (2, 1, "user", "Hello?"), (3, 0, "system", "Be.")]
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    got = defaultdict(list)
    for r in turns.repaired(df).orderBy("conv_id", "at").collect():
        got[r.conv_id].append((r.role, r.text))
    report_ = {r.conv_id: r for r in turns.repair(df).collect()}
    assert set(report_) == {1, 2, 3} and set(got) <= {1, 2, 3}
    for c, r in report_.items():
        assert LEGAL.fullmatch("".join(x[0] for x, _ in got[c]))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in got[c]).encode()).hexdigest() == r.repaired_sha256
    assert report_[2].audit == "KR" and got[2] == [("user", "Hi."), ("assistant", "Hello?")]
    assert report_[3].audit == "D"
    assert turns.repair(df.limit(0)).count() == 0 and turns.repaired(df.limit(0)).count() == 0


def test_text_ids(spark):
    df = spark.createDataFrame([("a", 1, "user", "Hi."), ("a", 2, "assistant", "Yes."), ("b", 1, "user", "Hm")],
                               "conv_id string, turn int, role string, text string")
    assert {(r.conv_id, r.audit, r.cost) for r in turns.repair(df).collect()} == {("a", "KK", 0), ("b", "D", 2)}
