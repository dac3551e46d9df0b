"""Near-duplicate classes by circulant MinHash, banding and exact Jaccard on full shingle sets.

Two permutations generate the whole signature: ``sigma`` scatters the shingles
over a universe of 2^32 places, and ``pi`` ranks the places; coordinate ``k``
is the smallest ``pi(sigma(x) - k)`` over the set, so every further coordinate
is the same ``pi`` circularly shifted by one place. Bands of consecutive
coordinates give the candidate buckets.

Buckets never expand into all their pairs while that can be avoided: first
every set is compared with one bucket leader per round (linear work; the leader
of the first round is the member that meets most others), classes are formed,
and only pairs of sets that still lie in different classes and meet in a bucket
are compared exhaustively. A sketch of one bit per coordinate keeps pairs apart
that merely share a passage: two sets at Jaccard 0.75 differ in 37.5 of 300 bits
on average (deviation 5.7), and only pairs with more than ``MAX_BITS`` differing
bits are left out, five deviations away. The exhaustive step also uses an exact
bound on the common shingles, from what each set holds of the bucket's most
central set. No cap on bucket sizes or partners.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm.common import staged, table
from vigilo.llm.graph import components

SHINGLE = 5
BANDS, ROWS = 50, 6   # misses a pair at Jaccard 0.75 with probability (1 - 0.75**6)**50 < 6e-5
THRESHOLD = 75        # percent
LEADER_ROUNDS = 2
SKETCH = (BANDS * ROWS + 63) // 64
MAX_BITS = 66


def shingle_ids(text: str | None, width: int = SHINGLE):
    """Sorted distinct 64-bit ids of the word shingles of one text (empty array without words)."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: lower-cases A-Z, splits ASCII space
    if not words:
        return np.zeros(0, np.uint64)
    one = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(one, words), np.uint64, len(words))
    w = min(width, len(words))
    n = len(words) - w + 1
    acc = np.full(n, w, np.uint64)
    for i in range(w):
        acc = (acc ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    return np.unique(acc)


def _mix32(x):
    """The ranking permutation ``pi`` of the 2^32 places, in place (a bijection: xor-shifts and odd multipliers)."""
    import numpy as np

    t = x >> np.uint32(16)
    x ^= t
    x *= np.uint32(0x7FEB352D)
    np.right_shift(x, np.uint32(15), out=t)
    x ^= t
    x *= np.uint32(0x846CA68B)
    np.right_shift(x, np.uint32(16), out=t)
    x ^= t
    return x


def circulant_signature(ids, coordinates: int = BANDS * ROWS):
    """All MinHash coordinates of one set from the two permutations (uint32 array)."""
    import numpy as np

    places = ((ids * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)  # sigma
    sig = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    shifts = np.arange(1, coordinates + 1, dtype=np.uint32)[:, None]
    block, rows = 4096, 32
    for a in range(0, len(places), block):
        part = places[None, a:a + block]
        for k in range(0, coordinates, rows):
            ranks = _mix32(part - shifts[k:k + rows])
            np.minimum(sig[k:k + rows], ranks.min(axis=1), out=sig[k:k + rows])
    return sig


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import numpy as np
    import xxhash

    tags = np.arange(BANDS, dtype=np.uint32)[:, None]
    for df in batches:
        n, sid, keys, bits = [], [], [], []
        for text in df["text"]:
            ids = shingle_ids(text)
            n.append(len(ids))
            if not len(ids):
                sid.append(0)
                keys.append(None)
                bits.append(None)
                continue
            sid.append(xxhash.xxh3_64_intdigest(ids.tobytes()) - (1 << 63))
            sig = circulant_signature(ids)
            low = np.zeros(64 * SKETCH, np.uint8)
            low[:len(sig)] = sig & np.uint32(1)
            bits.append(np.packbits(low).view(np.int64))
            bands = np.hstack([tags, sig.reshape(BANDS, ROWS)])
            keys.append([xxhash.xxh3_64_intdigest(b.tobytes()) - (1 << 63) for b in bands])
        yield pd.DataFrame({"doc_id": df["doc_id"], "n_shingles": n, "sid": sid, "bands": keys, "bits": bits, "text_hash": df["text_hash"]})


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(u, v)`` whose full sets reach the threshold."""
    a = sets.select(F.col("sid").alias("u"), F.col("ids").alias("a"))
    b = sets.select(F.col("sid").alias("v"), F.col("ids").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    return (pairs.join(a, "u").join(b, "v")
            .where(100 * common >= THRESHOLD * (F.size("a") + F.size("b") - common)).select("u", "v"))


def _sharable(sets: DataFrame, mixed: DataFrame) -> DataFrame:
    """``(sid, own)``: the shingles of each set that stand in another set of ``mixed`` too; hopeless sets are left out."""
    own = sets.join(mixed.select("sid").distinct(), "sid", "left_semi")
    each = own.select("sid", F.size("ids").alias("size"), F.explode("ids").alias("x"))
    common = each.groupBy("x").agg(F.count("*").alias("c")).where("c > 1").select("x")
    return (each.join(common, "x").groupBy("sid", "size").agg(F.collect_list("x").alias("own"))
            .where(100 * F.size("own") >= THRESHOLD * F.col("size")).select("sid", "own"))


def _seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import numpy as np

    for df in batches:
        seen, rest = [], []
        for own, ref in zip(df["own"], df["ids"]):
            hit = np.isin(ref, own)
            low = np.zeros(-(-len(hit) // 64) * 64, np.uint8)
            low[:len(hit)] = hit
            seen.append(np.packbits(low).view(np.int64))
            rest.append(len(own) - int(hit.sum()))
        yield pd.DataFrame({"sid": df["sid"], "ref": df["ref"], "seen": seen, "rest": rest})


def _against_references(sets: DataFrame, mixed: DataFrame) -> DataFrame:
    """Bucket rows with what each set holds of the bucket's reference set (a bitmap) and how much else it may share.

    The reference of a bucket is its most central member. Two sets share at most
    the reference's shingles that both hold and the smaller of their remainders.
    """
    lead = mixed.groupBy("key").agg(F.min_by("sid", F.struct((-F.col("meets")).alias("m"), "sid")).alias("ref"))
    rows = mixed.join(lead, "key")
    views = (rows.select("sid", "ref").distinct().join(_sharable(sets, mixed), "sid")
             .join(sets.select(F.col("sid").alias("ref"), "ids"), "ref").select("sid", "ref", "own", "ids")
             .mapInPandas(_seen, "sid long, ref long, seen array<long>, rest long"))
    return rows.join(views, ["sid", "ref"])


def _with_class(buckets: DataFrame, edges: DataFrame) -> DataFrame:
    """Buckets with each set's present class; buckets within one class are dropped."""
    classed = (buckets.join(components(edges), F.col("sid") == F.col("node"), "left")
               .withColumn("root", F.coalesce("root", "sid")).drop("node"))
    mixed = classed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return classed.join(mixed.select("key"), "key", "left_semi")


def _apart(x: str, y: str):
    """Number of differing sketch bits."""
    return sum((F.bit_count(F.col(f"{x}bits")[k].bitwiseXOR(F.col(f"{y}bits")[k])) for k in range(SKETCH)), F.lit(0))


def _likely(x: str, y: str):
    """Sizes that allow the threshold, and sketches that do not rule it out."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    return (100 * F.least(n, m) >= THRESHOLD * F.greatest(n, m)) & (_apart(x, y) <= MAX_BITS)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row per input row: doc_id, text_hash, n_shingles, component_id, kept.

    Texts are compared as sets of distinct 5-word shingles (fewer words: the whole
    sequence; null or wordless: empty, linked with nothing). Equal sets form one
    node; different sets are linked at Jaccard >= 0.75, confirmed on the full sets;
    ``component_id`` is the smallest doc_id of the class. Ties cannot occur in
    the minimum; repeated rows are copies of each other (each is returned; rows
    sharing the smallest id are all kept). A null doc_id never names a class while
    another id is there; such rows carry kept = false. Other columns are ignored.
    No rows give no rows.
    """
    id_type = docs.schema["doc_id"].dataType
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    # The id travels as text: a null would turn a whole batch of numbers into floats.
    signed = staged(docs.withColumn("doc_id", F.col("doc_id").cast("string"))
                    .mapInPandas(_signatures, "doc_id string, n_shingles long, sid long, bands array<long>, bits array<long>, text_hash long")
                    .withColumn("doc_id", F.col("doc_id").cast(id_type)), "signed")
    full = signed.where("n_shingles > 0")
    nodes = full.groupBy("sid").agg(F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
                                    F.first("bits").alias("bits"), F.min("doc_id").alias("rep"),
                                    F.min("text_hash").alias("text_hash"))
    exploded = nodes.select("sid", "n", "bits", F.explode("bands").alias("key"))
    shared = exploded.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    met = staged(exploded.join(shared, "key"), "met")
    buckets = staged(met.drop("c").join(met.groupBy("sid").agg(F.sum("c").alias("meets")), "sid"), "buckets")

    wanted = buckets.select("sid").distinct()
    source = (nodes.select("sid", "rep", "text_hash").join(wanted, "sid", "left_semi")
              .withColumnRenamed("rep", "doc_id"))
    # A doc_id may repeat with other texts, so the set is recomputed and its own digest checked against the node's.
    sets = staged(_sets_of(docs, source), "sets")

    edges = buckets.sparkSession.createDataFrame([], "u long, v long")
    tested = edges
    for r in range(LEADER_ROUNDS + 1):
        mixed = _with_class(buckets, edges)
        if r < LEADER_ROUNDS:
            rank = F.struct(F.xxhash64("sid", F.lit(r)).alias("h"), "sid") if r else F.struct((-F.col("meets")).alias("h"), "sid")
            lead = mixed.groupBy("key").agg(F.min_by(F.struct("sid", "n", "root", "bits"), rank).alias("l"))
            lead = lead.select("key", *[F.col(f"l.{c}").alias(f"l_{c}") for c in ("sid", "n", "root", "bits")])
            pairs = (mixed.join(lead, "key").where((F.col("root") != F.col("l_root")) & _likely("", "l_"))
                     .groupBy("sid").agg(F.min_by("l_sid", F.struct(_apart("", "l_").alias("d"), "l_sid")).alias("w"))
                     .select(F.least("sid", "w").alias("u"), F.greatest("sid", "w").alias("v")))
        else:
            mixed = staged(mixed, "mixed")
            mixed = _against_references(sets, mixed)
            other = mixed.select("key", *[F.col(c).alias(f"o_{c}") for c in ("sid", "n", "root", "bits", "seen", "rest")])
            both = F.aggregate(F.zip_with("seen", "o_seen", lambda x, y: F.bit_count(x.bitwiseAND(y)).cast("long")),
                               F.lit(0).cast("long"), lambda acc, x: acc + x)
            most = both + F.least("rest", "o_rest")
            pairs = (mixed.join(other, "key")
                     .where((F.col("sid") < F.col("o_sid")) & (F.col("root") != F.col("o_root")) & _likely("", "o_")
                            & (100 * most >= THRESHOLD * (F.col("n") + F.col("o_n") - most)))
                     .select(F.col("sid").alias("u"), F.col("o_sid").alias("v")))
        pairs = staged(pairs.distinct().join(tested, ["u", "v"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        tested = tested.unionByName(pairs)
        edges = staged(edges.unionByName(_verified(pairs, sets)), "edges")

    classes = components(edges)
    named = (full.select("doc_id", "sid").join(classes, F.col("sid") == F.col("node"), "left")
             .select("doc_id", "sid", F.coalesce("root", "sid").alias("root")))
    names = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_sid = named.select("sid", "root").distinct().join(names, "root").select("sid", "component_id")
    out = signed.drop("bands", "bits").join(of_sid, "sid", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _sets_of(docs: DataFrame, source: DataFrame) -> DataFrame:
    picked = docs.join(source.drop("text_hash"), "doc_id").select("sid", "text")
    # Texts that only rows without an id have are fetched by their hash, one copy of each.
    nameless = (docs.where("doc_id is null").join(source.where("doc_id is null").drop("doc_id"), "text_hash")
                .select("sid", "text").dropDuplicates(["sid"]))
    return picked.unionByName(nameless).mapInPandas(_checked_sets, "sid long, ids array<long>").dropDuplicates(["sid"])


def _checked_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import xxhash

    for df in batches:
        ids = [shingle_ids(t) for t in df["text"]]
        own = [xxhash.xxh3_64_intdigest(i.tobytes()) - (1 << 63) == s for i, s in zip(ids, df["sid"])]
        keep = [k for k, ok in enumerate(own) if ok]
        yield pd.DataFrame({"sid": df["sid"].iloc[keep].to_numpy(), "ids": pd.Series([ids[k].view("int64") for k in keep], dtype=object)})


def op5_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


#: Exact twin: every pair that shares a shingle, full Jaccard, components by reachability.
ORACLE = """
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
s as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from w),
g as (select s.*, md5(array_to_string(list_sort(s), chr(10))) as k from s),
u as (select k, min(doc_id) as id, any_value(s) as s from g where len(s) > 0 group by k),
e as (select id, unnest(s) as x from u),
p as (select a.id as a, b.id as b, count(*) as c from e a join e b on a.x = b.x and a.id < b.id group by 1, 2),
l as (select a, b from p join u ua on ua.id = a join u ub on ub.id = b
  where 100 * c >= 75 * (len(ua.s) + len(ub.s) - c)),
both_ways as (select a, b from l union all select b, a from l),
reach(id, r) as (select id, id from u union select both_ways.b, reach.r from reach join both_ways on both_ways.a = reach.id),
c as (select id, min(r) as component_id from reach group by id)
select g.doc_id, len(g.s)::bigint as n_shingles, coalesce(c.component_id, g.doc_id) as component_id,
  g.doc_id = coalesce(c.component_id, g.doc_id) as kept
from g left join u on u.k = g.k and len(g.s) > 0 left join c on c.id = u.id
"""
