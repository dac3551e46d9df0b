"""Secret scan with multipart credential linking (DataFrame functions only).

Strong patterns report at once (assignments, access identifiers, long hex
runs). Weak candidates - short access identifiers, bare key material,
endpoints - mean nothing alone: they are reported only when a complementary
part lies within the same scope, before or behind them: a part never
complements what it overlaps. Scopes are windows of ``SCOPE`` characters
around a part; parts meet by an interval join on (document, scope cell),
where each part looks at its own and the neighbouring cell on either side.
Candidates run to their natural end, whatever their length. A run inside an
address or a path is no key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.llm.common import let, table
from vigilo.llm import spans as S

BASE = ["assign", "access", "hex"]
WEAK = ["weak_id", "weak_key", "weak_endpoint"]
KINDS = BASE + WEAK
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ACCESS = r"AKIA[A-Z0-9]{16,}"     # the same matches as AKIA[A-Z0-9]+ with 20 characters or more
HEX = r"[0-9a-f]{24,}"            # the same matches as maximal runs of 24 or more
#: Distance in characters within which parts complement each other.
SCOPE = 200
WEAK_PATTERNS = {
    # an identifier-like token: capital prefix of a vendor key or a labelled client / account / user id
    "weak_id": r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA|AIza|SK|AC)[A-Za-z0-9_-]{8,}+|(?i:client_?id|account_?id|user(?:name)?|login)"
               r"\x20*+[:=]\x20*+[\"']?[A-Za-z0-9_.@-]{3,}+)(?![A-Za-z0-9])",
    # bare key material: 20 characters or more of base64 alphabet, not part of a longer run
    "weak_key": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])",
    # a service address
    "weak_endpoint": r"(?<![A-Za-z0-9])(?:(?:https?|ftp|jdbc|mongodb|postgres(?:ql)?|mysql|redis|amqp)://[^\x20\x09-\x0D\"'<>]{4,}+"
                     r"|(?i:endpoint|host)\x20*+[:=]\x20*+[\"']?[A-Za-z0-9.-]{3,}+)",
}
#: A key has digits and both cases, and is no path: parted by slashes, with one number at most in every segment.
KEY_HAS = ("[0-9]", "[A-Z]", "[a-z]")
SEGMENT = r"^[A-Za-z_+-]*+[0-9]*+[A-Za-z_+=-]*+$"
#: Which parts make a weak candidate credible. A strong span counts as its class.
PART = {"assign": "key", "hex": "key", "weak_key": "key", "access": "id", "weak_id": "id", "weak_endpoint": "place"}
COMPLEMENT = {"weak_id": ["key"], "weak_key": ["id", "place"], "weak_endpoint": ["key"]}


def _has_any(text: Column, *needles: str) -> Column:
    hit = F.lit(False)
    for n in needles:
        hit = hit | F.contains(text, F.lit(n))
    return hit


def base_spans(text: Column) -> Column:
    lower = F.lower(text)
    assign = S.found(text, ASSIGN, "assign", _has_any(lower, "pass", "secret", "token", "key"))
    strong = F.filter(assign, lambda x: F.length(F.regexp_replace(x["v"], ASSIGN_VALUE, "")) >= 6)
    return F.concat(strong, S.found(text, ACCESS, "access", _has_any(text, "AKIA")),
                    S.found(text, HEX, "hex", text.rlike(HEX)))


def weak_spans(text: Column) -> Column:
    lower = F.lower(text)
    gate = {"weak_id": _has_any(text, "AKIA", "ASIA", "AIza", "SK", "AC") | _has_any(lower, "client", "account", "user", "login"),
            "weak_key": text.rlike("[A-Za-z0-9+/_-]{20}"),
            "weak_endpoint": _has_any(text, "://") | _has_any(lower, "endpoint", "host")}
    ids, keys, places = (S.found(text, p, k, gate[k]) for k, p in WEAK_PATTERNS.items())
    path = lambda v: F.contains(v, F.lit("/")) & F.forall(F.split(v, "/", -1), lambda x: x.rlike(SEGMENT))
    mixed = lambda v: v.rlike(KEY_HAS[0]) & v.rlike(KEY_HAS[1]) & v.rlike(KEY_HAS[2])
    keys = F.filter(keys, lambda x: mixed(x["v"]) & ~path(x["v"]))
    free = let(places, lambda at: F.filter(keys, lambda x: ~F.exists(at, lambda p: (p["s"] < x["e"]) & (x["s"] < p["e"]))))
    return F.concat(ids, F.when(F.size(keys) > 0, free).otherwise(S.none()), places)


def scan(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row per input row: doc_id, base, linked (arrays of spans).

    ``base`` holds the strong spans, ``linked`` the weak candidates for which a
    complementary part lies within SCOPE characters in the same text. Null text
    is empty. The parts are keyed by the text itself (its hash), so repeated rows,
    equal or null doc_ids get their own right answers. Extra columns are ignored;
    no rows give no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("h"), F.length(text).alias("len"),
                       base_spans(text).alias("base"), weak_spans(text).alias("weak"))
    linked = _linked(rows)
    return (rows.drop("weak").join(linked, ["h", "len"], "left")
            .select("doc_id", "base", F.coalesce("linked", S.none()).alias("linked")))


def _linked(rows: DataFrame) -> DataFrame:
    """Weak spans of each text that have a complementary part within the scope."""
    strong = F.transform("base", lambda x: x.dropFields("v"))
    weak = F.transform("weak", lambda x: x.dropFields("v"))
    parts = (rows.where(F.size("weak") > 0).select("h", "len", F.explode(F.concat(strong, weak)).alias("x"))
             .select("h", "len", "x.*").distinct()
             .withColumn("part", F.element_at(F.create_map(*[F.lit(v) for kv in PART.items() for v in kv]), F.col("kind"))))
    cell = lambda p: F.floor(p / F.lit(SCOPE)).cast("int")
    needs = F.create_map(*[v for k, c in COMPLEMENT.items() for v in (F.lit(k), F.array(*[F.lit(x) for x in c]))])
    look = lambda side, first: F.struct(F.lit(side).alias("side"), first.alias("cell"))
    asking = (parts.where(F.col("kind").isin(*WEAK))
              .select("h", "len", "kind", "s", "e", F.explode(F.element_at(needs, F.col("kind"))).alias("part"))
              .withColumn("look", F.explode(F.array(
                  look("behind", cell(F.col("e"))), look("behind", cell(F.col("e")) + 1),
                  look("before", cell(F.col("s")) - 1), look("before", cell(F.col("s"))))))
              .select("*", "look.*").drop("look"))
    # Cells are as wide as the scope, so of a class's parts in a cell only the outermost edges matter: no pairs pile up.
    # A part behind starts in the cell of the asking end (its last start decides) or the next one (its first start does).
    edge = F.explode(F.array(F.struct(F.lit("behind").alias("side"), F.col("s").alias("p")),
                             F.struct(F.lit("before").alias("side"), F.col("e").alias("p"))))
    offered = (parts.select("h", "len", "part", edge.alias("edge")).select("h", "len", "part", "edge.*")
               .groupBy("h", "len", "part", "side", cell(F.col("p")).alias("cell"))
               .agg(F.min("p").alias("low"), F.max("p").alias("high")))
    near = (((F.col("side") == "behind") & (F.col("high") >= F.col("e")) & (F.col("low") <= F.col("e") + SCOPE)) |
            ((F.col("side") == "before") & (F.col("low") <= F.col("s")) & (F.col("high") >= F.col("s") - SCOPE)))
    return (asking.join(offered, ["h", "len", "part", "side", "cell"]).where(near)
            .select("h", "len", "kind", "s", "e").distinct()
            .groupBy("h", "len").agg(F.collect_list(F.struct("kind", "s", "e", F.lit("").alias("v"))).alias("linked")))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with strong and linked spans replaced by ``[kind]`` (n_chars follows where the column exists)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumns({"_h": F.xxhash64(text), "_len": F.length(text), "_base": base_spans(text)})
    parts = docs.select(F.xxhash64(text).alias("h"), F.length(text).alias("len"), base_spans(text).alias("base"),
                        weak_spans(text).alias("weak"))
    linked = _linked(parts).toDF("_h", "_len", "_linked")
    joined = rows.join(linked, ["_h", "_len"], "left")
    all_spans = F.concat("_base", F.coalesce("_linked", S.none()))
    clean = joined.withColumn("text", F.when(F.col("text").isNull(), F.col("text")).otherwise(S.masked(text, all_spans)))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.size(all_spans) > 0, F.length("text").cast("long"))
                                 .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def op2_secret_linking(spark, sf_dir):
    rows = scan(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", S.counted(F.col("base"), "assign").alias("n_assign"), S.counted(F.col("base"), "access").alias("n_access"),
        S.counted(F.col("base"), "hex").alias("n_hex"), S.sha256(S.written(F.col("base"), KINDS)).alias("base_sha256"),
        S.written(F.concat("base", "linked"), KINDS).alias("spans"))
