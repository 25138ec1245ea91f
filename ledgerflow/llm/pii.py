"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base entities are found by one pattern per kind. They are the seeds. What stands around an identifier are
its lexical patterns: the word on its left, the two words there, the word on its right, and the words on
both sides, lower-cased and with each number read as one sign. Patterns and the identifiers that they stand
around form a graph over the whole corpus. A pattern scores by the share of its identifiers that are of
a kind: seeds weigh 1, an unseen identifier whose shape fits weighs the best score of its patterns. The two
are computed from each other for some rounds. A pattern takes part for a kind as soon as it has enough
distinct seeds and trusted finds, so finds of one round induce the patterns of the next. Patterns with a
high score at the end mark the identifiers that no base pattern matches, where their shape fits the kind.

Only texts with a digit or an at sign can hold any of this; the others are not taken further. What
is shuffled are the matches with 64-bit digests of their patterns, not the texts, so a text with very many
matches is spread out like any other rows. Weights are decimals: their sums do not depend on the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone")
# The base patterns, written so that Java's matcher neither recurses nor tries a run again from
# each of its places: same matches, linear time. \G lets an address start where the last one ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]"
             r"(?:[A-Za-z0-9.-](?<!\.(?![A-Za-z0-9-])))*+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[0-9\x20-](?<![\x20-](?![0-9])))++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# An identifier-like token: a word with a digit or an at sign.
TOKEN = (r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
# Punctuation around a token that is not part of it; "(030)555" keeps its bracket.
AROUND = (r"^(?:(?!\([0-9+]+\)[0-9])[\p{Ps}\p{Pe}\p{Pi}\p{Pf}<>\"'*,;:.!?])+",
          r"[\p{Ps}\p{Pe}\p{Pi}\p{Pf}<>\"'*,;:.!?]+$")
# Digit groups with single blanks between them, and the phone or card at the start of such a run.
RUN = (r"(?<![^\x20\x09-\x0D])[\p{Ps}\p{Pi}<\"'*]*+\+?[0-9][0-9().-]*+(?:\x20\(?[0-9][0-9().-]*+)++")
SPACED = (r"^[+(]?[0-9](?:[0-9().-]|\x20(?=[(0-9])){5,18}[0-9](?![0-9])",
          r"^[0-9](?:[\x20-]?[0-9]){9,22}(?![0-9])")
# What an unseen identifier must look like to be taken for a kind.
SHAPES = {
    "email": r"^[^@]+@[^@]+$",
    "ip": r"^[0-9]+([.:][0-9]+){2,}$",
    "card": r"^[0-9]([\x20-]?[0-9]){9,22}$",
    "phone": r"^[+(]?[0-9](?:[0-9().-]|\x20(?=[(0-9])){5,18}[0-9]$",
}
ROUNDS = 4
MIN_SEEDS = 8
MIN_SCORE = 0.9
WEIGHT = "decimal(12,10)"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's check of a text of digits."""
    one = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).when(c.cast("int") > 4, 2 * c.cast("int") - 9)
        .otherwise(2 * c.cast("int")))
    return F.aggregate(one, F.lit(0), lambda a, x: a + x) % 10 == 0


def accepted(kind: Column, m: Column) -> Column:
    """Whether a match of a kind's pattern is one of its entities."""
    n = F.length(_digits(m))
    card = F.when(n.between(12, 19), _luhn(_digits(m))).otherwise(False)
    part = r"0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return (F.when(kind == "email", True).when(kind == "ip", m.rlike(rf"^{part}(\.{part}){{3}}$"))
            .when(kind == "card", card).when(kind == "phone", n.between(9, 15))
            .otherwise(True))


def _contexts(before: Column, after: Column) -> Column:
    """Digests of the lexical patterns of what stands between two texts."""
    def plain(text):
        return F.translate(text, "\t\n\x0b\x0c\r", "     ")

    def general(words):
        return F.regexp_replace(F.lower(words), "[0-9]+", "0")

    left, right = F.rtrim(plain(before)), F.ltrim(plain(after))
    one, two = general(F.substring_index(left, " ", -1)), general(F.substring_index(left, " ", -2))
    next_ = general(F.substring_index(right, " ", 1))
    found = F.array(F.when(one != "", F.xxhash64(F.lit("left"), one)),
                    F.when(two != one, F.xxhash64(F.lit("two"), two)),
                    F.when(next_ != "", F.xxhash64(F.lit("right"), next_)),
                    F.when((one != "") & (next_ != ""), F.xxhash64(F.lit("both"), one, next_)))
    return F.filter(found, lambda c: c.isNotNull())


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Array of (kind, i, gap, m, ctx): the matches in order, the length of the text between each and
    the one before, and the patterns it stands in, read from the texts up to its neighbours."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    n = F.size(matches)

    def item(m, g, after, i):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(g).alias("gap"),
                        m.alias("m"), _contexts(g, after).alias("ctx"))

    triples = F.arrays_zip(matches.alias("m"), F.slice(gaps, F.lit(1), n).alias("g"),
                           F.slice(gaps, F.lit(2), n).alias("r"))
    return F.transform(triples, lambda x, i: item(x["m"], x["g"], x["r"], i))


def _spaced(m: Column) -> Column:
    """The phone or card that a run of digit groups starts with, empty if its first group is an
    identifier by itself or none is found: the whole run if it fits, else as much as fits."""
    first = F.substring_index(m, " ", 1)
    alone = _fits(F.lit("phone"), first) | _fits(F.lit("card"), first) | _fits(F.lit("ip"), first)
    whole = _fits(F.lit("phone"), m) | _fits(F.lit("card"), m)
    phone, card = (F.regexp_extract(m, p, 0) for p in SPACED)
    return (F.when(alone, "").when(whole, m).when(F.contains(phone, F.lit(" ")), phone)
            .when(F.contains(card, F.lit(" ")), card).otherwise(""))


def _trimmed(placed: DataFrame) -> DataFrame:
    """Tokens and runs without the punctuation around them, runs as far as they are an identifier."""
    bare = F.col("kind").isin("token", "run")
    lead, tail = AROUND
    start = F.regexp_replace("m", lead, "")
    cut = F.regexp_replace(start, tail, "")
    return (placed.withColumn("s", F.when(bare, F.col("s") + F.length("m") - F.length(start))
                              .otherwise(F.col("s")))
            .withColumn("m", F.when(F.col("kind") == "run", _spaced(cut)).when(bare, cut)
                        .otherwise(F.col("m")))
            .withColumn("e", F.col("s") + F.length("m")).where("kind != 'run' OR m != ''"))


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, kind, s, e, m, ctx): accepted base entities, and as kind ``token`` all identifier-like
    tokens, as kind ``run`` phones and cards written with blanks, both without the punctuation around
    them, with places in code points (end exclusive). ``h`` is the md5 of the text: a document is
    an id with a text, and repeated rows count once."""
    some = docs.where(F.col(text_col).rlike("[0-9@]")).select(
        F.col(id_col).alias("id"), F.md5(F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    by_kind = F.array(*[_found(F.col("text"), k, p) for k, p in PATTERNS.items()],
                      _found(F.col("text"), "token", TOKEN), _found(F.col("text"), "run", RUN))
    flat = (some.select("id", "h", F.explode(by_kind).alias("of_kind"))
            .select("id", "h", F.inline("of_kind")).distinct())
    w = Window.partitionBy("id", "h", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("m")).over(w)
    placed = flat.withColumn("e", end).withColumn("s", F.col("e") - F.length("m"))
    return (_trimmed(placed.where(accepted(F.col("kind"), F.col("m"))))
            .select("id", "h", "kind", "s", "e", "m", "ctx"))


def unseen(found: DataFrame) -> DataFrame:
    """The tokens and runs of :func:`matches` that overlap no base entity; tokens in such a run are
    left out."""
    base = ~F.col("kind").isin("token", "run")
    by_doc = Window.partitionBy("id", "h").orderBy("s", base.cast("int").desc(), "kind")
    before = by_doc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = by_doc.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    seen = (found.withColumn("_before", F.max(F.when(base, F.col("e"))).over(before))
            .withColumn("_after", F.min(F.when(base, F.col("s"))).over(after)))
    free = seen.where(~base & ~F.coalesce(F.col("_before") > F.col("s"), F.lit(False))
                      & ~F.coalesce(F.col("_after") < F.col("e"), F.lit(False))
                      ).drop("_before", "_after")
    runs = F.max(F.when(F.col("kind") == "run", F.col("e"))).over(before)
    return (free.withColumn("_run", runs)
            .where((F.col("kind") == "run") | ~F.coalesce(F.col("_run") > F.col("s"), F.lit(False)))
            .drop("_run"))


def _fits(kind: Column, m: Column) -> Column:
    out = F.lit(False)
    for k, shape in SHAPES.items():
        out = F.when(kind == k, m.rlike(shape)).otherwise(out)
    return out


def patterns(found: DataFrame, unknown: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
             min_score: float = MIN_SCORE) -> DataFrame:
    """(p, kind): the lexical patterns in which bootstrapping trusts, by their digests.

    The graph's edges are the distinct (pattern, identifier) pairs, so copies of a document add
    nothing. A seed weighs 1 for its own kind and 0 for the others; an unseen identifier whose shape
    fits a kind weighs, for this kind, the best score of its patterns, 0 at first. A pattern's score
    for a kind is the mean weight of its identifiers. It has one when at least ``min_seeds`` of them are
    seeds, or, counting only finds that weigh ``min_score``, seeds and finds. Sums are combined before
    each shuffle.
    """
    def edges(rows, *columns):
        return rows.select(F.explode("ctx").alias("p"), "m", *columns).distinct()

    seeds = edges(found.where(~F.col("kind").isin("token", "run")), "kind")
    open_ = edges(unknown)
    size = (seeds.select("p", "m").distinct().unionAll(open_).groupBy("p").agg(F.count("*").alias("n")))
    seeded = seeds.groupBy("p", "kind").agg(F.count("*").alias("seeds"))
    fitting = F.filter(F.array(*map(F.lit, KINDS)), lambda k: _fits(k, F.col("m")))
    open_ = stored(open_.select("p", "m", F.explode(fitting).alias("kind")), "open")
    counted = stored(open_.select("p", "kind").unionAll(seeded.select("p", "kind")).distinct()
                     .join(seeded, ["p", "kind"], "left").join(size, "p")
                     .select("p", "kind", F.coalesce("seeds", F.lit(0)).alias("seeds"), "n"), "counted")
    trusted = F.lit(str(min_score)).cast(WEIGHT)

    def scored(weight: Column) -> Column:
        return (weight / F.col("n")).cast(WEIGHT).alias("score")

    score = counted.where(F.col("seeds") >= min_seeds).select(
        "p", "kind", scored(F.col("seeds").cast("decimal(20,0)")))
    for _ in range(rounds):
        weight = open_.join(score, ["p", "kind"]).groupBy("kind", "m").agg(F.max("score").alias("w"))
        gain = open_.join(weight, ["kind", "m"]).groupBy("p", "kind").agg(
            F.sum("w").alias("all"), F.sum(F.when(F.col("w") >= trusted, F.col("w"))).alias("sure"),
            F.count(F.when(F.col("w") >= trusted, 1)).alias("finds"))
        both = counted.join(gain, ["p", "kind"], "left").na.fill(0, ["finds"])
        own = F.col("seeds") >= min_seeds
        added = F.coalesce(F.when(own, F.col("all")).otherwise(F.col("sure")), F.lit(0))
        score = stored(both.where(own | (F.col("seeds") + F.col("finds") >= min_seeds)).select(
            "p", "kind", scored(F.col("seeds") + added)), "patterns")
    return score.where(F.col("score") >= trusted).select("p", "kind")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
         min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE) -> DataFrame:
    """(id, h, kind, s, e, m, base): every span found, one row each; ``base`` tells the seeds from
    what bootstrapping added. Places are code points, end exclusive. Null and empty texts have no
    span. A token fitting several trusted kinds takes the first as listed in ``KINDS``."""
    found = stored(matches(docs, id_col, text_col), "spans")
    unknown = stored(unseen(found), "unseen")
    trusted = patterns(found, unknown, rounds, min_seeds, min_score)
    order = _order(F.col("kind"))
    around = unknown.drop("kind").withColumn("p", F.explode("ctx")).drop("ctx")
    added = (around.join(trusted, "p").where(_fits(F.col("kind"), F.col("m")))
             .groupBy("id", "h", "s", "e", "m").agg(F.min_by("kind", order).alias("kind")))
    cols = ["id", "h", "kind", "s", "e", "m"]
    return (found.where("kind NOT IN ('token', 'run')").select(*cols, F.lit(True).alias("base"))
            .unionAll(added.select(*cols, F.lit(False).alias("base"))))


def _order(kind: Column) -> Column:
    out = F.lit(len(KINDS))
    for i, k in enumerate(KINDS):
        out = F.when(kind == k, i).otherwise(out)
    return out


def spans_per_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       **options) -> DataFrame:
    """(``id_col``, n_<kind> of the base spans, base, spans) for each row of ``docs``; the last two
    list ``kind:start:end`` by start, then kind as listed, joined by commas. Rows with a null id are
    told apart by their texts; other columns are not read."""
    found = find(docs, id_col, text_col, **options)
    line = F.concat_ws(":", "kind", F.col("s").cast("string"), F.col("e").cast("string"))
    item = F.struct(F.col("s"), _order(F.col("kind")).alias("o"), line.alias("line"))
    per = found.groupBy(F.col("id").alias("_id"), F.col("h").alias("_h")).agg(
        *[F.count(F.when((F.col("kind") == k) & F.col("base"), 1)).alias(f"n_{k}") for k in KINDS],
        F.sort_array(F.collect_list(F.when(F.col("base"), item))).alias("base"),
        F.sort_array(F.collect_list(item)).alias("spans"))
    rows = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(text_col, F.lit(""))).alias("h"))
    joined = rows.join(per, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")

    def text(name):
        return F.coalesce(F.array_join(F.transform(name, lambda x: x["line"]), ","), F.lit(""))

    return joined.select(F.col("id").alias(id_col),
                         *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
                         text("base").alias("base"), text("spans").alias("spans"))
