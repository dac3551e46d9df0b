"""Document quality rules with cross-document line frequency (DataFrame functions only).

Per document: counts of words, symbols, repeated lines and repeated 3-word
windows. Across documents: normalised lines are hashed, distinct documents
are counted per host and line, lines above the limit are boilerplate in all
documents but the first that holds them (so that of many near copies one
stays whole), and a document that keeps too little of its words is depleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.llm.common import SPACE_CLASS, let, staged, table, words

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line is boilerplate of a host when it stands in more than this many of the host's distinct documents, however large the host.
LINE_MAX_DOCS = 10
#: A document is depleted when less than this share of its word characters is left.
MIN_LEFT_PERCENT = 30


def _unspaced(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def _line_hash(line: Column) -> Column:
    flat = F.trim(F.regexp_replace(line, f"[{SPACE_CLASS}]+", " "))
    return F.xxhash64(F.lower(flat))


def _facts(docs: DataFrame) -> DataFrame:
    """One row per document with its text hash and non-blank lines."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: _unspaced(x) != "")
    return docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
                       text.alias("text"), F.xxhash64(text).alias("text_hash"), lines.alias("lines"))


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more."""
    def covered(p: Column) -> Column:  # positions of such windows, ascending: each covers three words, less its overlap
        gap = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(gap, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def twice(g: Column) -> Column:  # windows by hash, then position: equal ones are neighbours
        same = lambda x, i: F.coalesce(F.get(g, i)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(g, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["p"]))

    window = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))
    windows = F.array_sort(F.transform(F.sequence(F.lit(0), F.size(w) - 3), window))
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(let(windows, twice), covered))


def base_counts(facts: DataFrame) -> DataFrame:
    """Adds the per-document counts to rows that have ``text`` and ``lines``."""
    t = F.col("text")
    of_words = let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r")))
    return facts.withColumn("of_words", of_words).select(
        "*", F.col("of_words.n").alias("n_words"), F.col("of_words.r").alias("n_repeat_words"),
        F.length(_unspaced(t)).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(F.col("lines"), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).drop("of_words")


def frequent_lines(hashed: DataFrame) -> DataFrame:
    """``hashed(doc_id, host, text_hash, hashes)`` -> ``(host, line, first)``: hashes of the lines above the limit.

    Counts distinct texts, so exact copies of a document count once. ``first``
    is the smallest doc_id that holds the line (null: no row with an id does).
    """
    seen = hashed.select("doc_id", "host", "text_hash", F.explode(F.array_distinct("hashes")).alias("line"))
    return (seen.groupBy("host", "line").agg(F.count_distinct("text_hash").alias("n"), F.min("doc_id").alias("first"))
            .where(F.col("n") > LINE_MAX_DOCS).select("host", "line", "first"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, source, ...)`` -> one row per input row.

    Columns: doc_id, text_hash, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, left_chars (word characters outside boilerplate
    lines), boilerplate (hashes of the removed lines), kept.

    Null text counts as empty (base_failed). Null source is the host "". A null
    doc_id is carried through. Repeated rows get the same answer and count once
    as documents of their host. Extra columns are ignored; no rows give no rows.
    """
    # One pass over the texts: counts, line hashes and line lengths are written once, all that follows reads those.
    sized = F.transform("lines", lambda x: F.struct(_line_hash(x).alias("h"), F.length(_unspaced(x)).alias("c")))
    rows = staged(base_counts(_facts(docs)).select(
        "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        sized.alias("sized")), "quality")
    hashed = rows.select("doc_id", "host", "text_hash", F.col("sized.h").alias("hashes"))
    heavy = frequent_lines(hashed)
    per_doc = (hashed.select("host", "text_hash", F.explode(F.array_distinct("hashes")).alias("line")).join(heavy, ["host", "line"])
               .groupBy("host", "text_hash").agg(F.collect_set(F.struct("line", "first")).alias("found")))
    failed = ((F.col("n_words") < MIN_WORDS) |
              (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    none = F.array().cast("array<bigint>")
    others = F.filter("found", lambda x: ~x["first"].eqNullSafe(F.col("doc_id")) | F.col("doc_id").isNull())
    joined = (rows.join(per_doc, ["host", "text_hash"], "left")
              .withColumn("boilerplate", F.coalesce(F.transform(others, lambda x: x["line"]), none)))
    gone = F.aggregate(F.filter("sized", lambda x: F.array_contains("boilerplate", x["h"])), F.lit(0).cast("long"),
                       lambda a, x: a + x["c"])
    left = F.when(F.size("boilerplate") == 0, F.col("word_chars")).otherwise(F.col("word_chars") - gone)
    return joined.select(
        "doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        left.alias("left_chars"), "boilerplate",
        (~failed & (100 * left >= MIN_LEFT_PERCENT * F.col("word_chars"))).alias("kept"))


def cleaned(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``docs`` without the boilerplate lines that ``verdicts`` (rows of ``quality_rules``) name; other columns as they are.

    Rows meet by doc_id and text, null ids among themselves; rows without boilerplate keep their text.
    """
    named = (verdicts.where(F.size("boilerplate") > 0)
             .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("boilerplate").alias("_gone"))
             .dropDuplicates(["_id", "_hash"]))
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    kept = F.filter(F.split("text", "\n", -1), lambda x: (_unspaced(x) == "") | ~F.array_contains(F.col("_gone"), _line_hash(x)))
    text = F.when(F.col("_gone").isNull() | F.col("text").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return (docs.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (own == F.col("_hash")), "left")
            .withColumn("text", text).select(*docs.columns))


def op4_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents")).drop("boilerplate", "text_hash")


ORACLE = r"""
with f as (select doc_id, coalesce(source, '') as host, coalesce(text, '') as t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
g as (select doc_id, unnest(range(1, len(w) - 1)) as p, w from f),
g3 as (select doc_id, p, array_to_string(w[p:p + 2], ' ') as k from g),
rep as (select doc_id, p from g3 qualify count(*) over (partition by doc_id, k) > 1),
cov as (select doc_id, count(distinct q) as n from (select doc_id, unnest([p, p + 1, p + 2]) as q from rep) group by 1),
ln as (select doc_id, host, t, unnest(lines) as raw from f),
l as (select doc_id, host, t, lower(trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g'))) as line,
    length(regexp_replace(raw, '[\x20\x09-\x0D]+', '', 'g')) as c from ln),
heavy as (select host, line, min(doc_id) as first from l group by host, line having count(distinct t) > 10),
gone as (select doc_id, sum(c) as c from l join heavy using (host, line) where doc_id <> first group by 1),
r as (select f.doc_id, len(w)::bigint as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(cov.n, 0)::bigint as n_repeat_words,
    coalesce(gone.c, 0)::bigint as gone
  from f left join cov using (doc_id) left join gone using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, word_chars - gone as left_chars,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * (word_chars - gone) >= 30 * word_chars as kept
from r
"""
