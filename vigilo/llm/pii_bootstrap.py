"""Personal data by bootstrapped contextual extraction (DataFrame functions only).

Strictly shaped entities (email, ip, card, phone) are the seeds. The two words
before a seed are a lexical pattern of its kind; every other token with digits
or an at sign is a candidate instance of the patterns it follows. Patterns and
instances form a graph that is scored in rounds: a pattern is worth the share of
believed values among the values it introduces, a value is believed when one of
its patterns vouches for it. Candidates behind high-confidence patterns with
enough distinct seeds are reported as unseen identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.llm import spans as S
from vigilo.llm.common import SPACE_CLASS, let, staged, table

BASE = ["email", "ip", "card", "phone"]
KINDS = BASE + [f"like_{k}" for k in BASE]
# The patterns start only where a leftmost match can start (at a run's first character or where the last match ended),
# so long runs cost one pass; loops over groups are bounded or atomic, so long texts do not exhaust the stack.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
         r"(?:(?>(?:\.[A-Za-z0-9-]++){1,300}))+")
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])"  # runs of 14 to 19 digits
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A candidate is a white-space token of 4 to 80 characters with this many digits, or with an at sign.
MIN_DIGITS = 4
#: Characters before a span in which its two context words are looked for.
CONTEXT = 60
ROUNDS = 3
MIN_SEEDS = 5
MIN_CONFIDENCE = 0.8


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    value = F.transform(F.split(F.reverse(digits), ""), lambda d, i: let(
        d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(value, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _ip_part(p: Column) -> Column:
    return let(F.regexp_replace(p, "^0+", ""), lambda x: (F.length(x) <= 3) & (F.coalesce(x.try_cast("int"), F.lit(0)) <= 255))


def base_spans(text: Column) -> Column:
    digit = text.rlike("[0-9]")
    email = S.found(text, EMAIL, "email", F.contains(text, F.lit("@")))
    ip = F.filter(S.found(text, IP, "ip", digit & text.rlike(r"[0-9]\.[0-9]")),
                  lambda x: F.forall(F.split(x["v"], r"\."), _ip_part))
    card = F.filter(S.found(text, CARD, "card", digit), lambda x: _luhn(_digits(x["v"])))
    phone = F.filter(S.found(text, PHONE, "phone", F.contains(text, F.lit("+")) & digit),
                     lambda x: F.length(_digits(x["v"])).between(10, 15))
    return F.concat(email, ip, card, phone)


def _candidates(text: Column) -> Column:
    def worth(x: Column) -> Column:
        return F.contains(x["v"], F.lit("@")) | (F.length(_digits(x["v"])) >= MIN_DIGITS)

    trimmed = lambda x: let(F.regexp_extract(x["v"], r"^([^\p{L}\p{N}+]*)(.*?)[^\p{L}\p{N}]*$", 1), lambda lead: let(
        F.regexp_extract(x["v"], r"^[^\p{L}\p{N}+]*(.*?)[^\p{L}\p{N}]*$", 1),
        lambda v: F.struct(F.lit("candidate").alias("kind"), (x["s"] + F.length(lead)).alias("s"),
                           (x["s"] + F.length(lead) + F.length(v)).alias("e"), v.alias("v"))))
    tokens = S.found(text, rf"(?<![^{SPACE_CLASS}])(?=[^{SPACE_CLASS}]{{0,79}}[0-9@])[^{SPACE_CLASS}]{{4,80}}(?![^{SPACE_CLASS}])",
                     "candidate", text.rlike("[0-9@]"))
    return F.filter(F.transform(F.filter(tokens, worth), trimmed), lambda x: x["e"] > x["s"])


def _context(text: Column, at: Column) -> Column:
    """The two words before a position, lower-cased, digits as 0; "" when there are none."""
    before = F.substring(text, F.greatest(at - CONTEXT, F.lit(0)) + 1, F.least(at, F.lit(CONTEXT)))
    words = F.regexp_extract(before, rf"(?:^|[{SPACE_CLASS}])([^{SPACE_CLASS}]+[{SPACE_CLASS}]+[^{SPACE_CLASS}]+)[{SPACE_CLASS}]+[^{SPACE_CLASS}\p{{L}}\p{{N}}]*$", 1)
    return F.regexp_replace(F.lower(F.regexp_replace(words, f"[{SPACE_CLASS}]+", " ")), "[0-9]", "0")


def _facts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = text.rlike("[0-9@]")
    placed = lambda spans: F.transform(spans, lambda x: F.struct(
        x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"), _context(text, x["s"]).alias("context")))
    empty = F.array().cast("array<struct<kind:string,s:int,e:int,v:string,context:string>>")
    return docs.select("doc_id", F.xxhash64(text).alias("h"), F.length(text).alias("len"),
                       F.when(some, let(base_spans(text), placed)).otherwise(empty).alias("base"),
                       F.when(some, let(_candidates(text), placed)).otherwise(empty).alias("tokens"))


def score_graph(mentions: DataFrame) -> DataFrame:
    """``mentions(kind, context, value, seed)`` -> ``(kind, context, confidence, seeds)`` after ROUNDS rounds.

    Candidates are offered to every kind whose seeds share a context with them.
    """
    seeds = mentions.where("seed").select("kind", "context", "value").distinct()
    patterns = seeds.groupBy("kind", "context").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= MIN_SEEDS)
    others = mentions.where("not seed").select("context", "value").distinct().join(patterns.select("kind", "context"), "context")
    edges = staged(seeds.join(patterns, ["kind", "context"], "left_semi").select("kind", "context", "value", F.lit(True).alias("seed"))
                   .unionByName(others.select("kind", "context", "value", F.lit(False).alias("seed"))), "edges")
    belief = edges.select("*", F.col("seed").cast("double").alias("b"))
    for r in range(ROUNDS):
        score = belief.groupBy("kind", "context").agg((F.sum("b") / (F.count("*") + 1)).alias("confidence"))
        if r == ROUNDS - 1:
            return score.join(patterns, ["kind", "context"])
        scored = edges.join(score, ["kind", "context"])
        value = (scored.where("not seed").groupBy("kind", "value")
                 .agg((1 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999)))))).alias("b")))
        belief = staged(edges.join(value, ["kind", "value"], "left")
                        .withColumn("b", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("b", F.lit(0.0)))), "belief")


def scan(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> doc_id, base, found (arrays of spans), one row per input row.

    ``base`` are the seeds, ``found`` the unseen identifiers behind high-confidence
    patterns, as ``like_<kind>``. Null text is empty. Equal texts count once as
    evidence and get equal answers, whatever their ids (null and repeated ids
    included). Extra columns are ignored; no rows give no rows.
    """
    facts = staged(_facts(docs), "facts")
    inside = lambda x: F.exists("base", lambda b: (x["s"] < b["e"]) & (b["s"] < x["e"]))
    free = F.filter("tokens", lambda x: ~inside(x))
    some = facts.where((F.size("base") > 0) | (F.size("tokens") > 0))
    mentions = staged(
        some.select("h", "len", F.explode(F.concat(F.transform("base", lambda x: x.withField("seed", F.lit(True))),
                                                   F.transform(free, lambda x: x.withField("seed", F.lit(False))))).alias("x"))
        .select("h", "len", "x.*").where("context <> ''").distinct()
        .withColumn("value", F.lower("v")), "mentions")
    good = score_graph(mentions).where(F.col("confidence") >= MIN_CONFIDENCE)
    hits = (mentions.where("not seed").drop("kind").join(good, "context")
            .groupBy("h", "len", "s", "e").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
            .groupBy("h", "len").agg(F.collect_list(F.struct(
                F.concat(F.lit("like_"), "kind").alias("kind"), "s", "e", F.lit("").alias("v"))).alias("found")))
    base = F.transform("base", lambda x: x.dropFields("context"))
    return (facts.select("doc_id", "h", "len", base.alias("base")).join(hits, ["h", "len"], "left")
            .select("doc_id", "base", F.coalesce("found", S.none()).alias("found")))


def op3_bootstrapped_pii(spark, sf_dir):
    rows = scan(table(spark, sf_dir, "documents"))
    base = F.col("base")
    return rows.select(
        "doc_id", *[S.counted(base, k).alias(f"n_{k}") for k in BASE], S.sha256(S.written(base, KINDS)).alias("base_sha256"),
        S.written(F.concat("base", "found"), KINDS).alias("spans"))
