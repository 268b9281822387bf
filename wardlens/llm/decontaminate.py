"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` stores one posting (term, doc_id, pos) per training token.
The index is sharded by document: every task inverts its own documents by a
local sort on the term, so no token is shuffled and no term, however frequent,
meets in one task. Terms are kept as 64-bit hashes; matches are compared with
the words themselves before they are returned.

``phrase_matches`` looks phrases up from their rarest terms: the postings of
the rarest term give candidate starts (position minus the term's offset in the
phrase), the lists of the next rarest terms, adjusted by their offsets, are
intersected with them, and the survivors are compared word by word with the
documents they point at. ``proximity_matches`` finds the places where all terms
of a phrase lie within a given distance, in any order.

Defined cases: null or empty text has no words; null benchmark text gives no
window; a benchmark row without ``item_id`` still marks words but is not
listed or counted; documents without ``doc_id`` cannot be named and are left
out; rows that share a ``doc_id`` are one document whose words are counted over
all rows and whose hit positions are united; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.llm.common import Workspace, ascii_lower, split_words

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
# Lists that are intersected before the words are compared.
INTERSECTED_TERMS = 3
# Delta encoding of the sorted terms and positions.
INDEX_OPTIONS = {"parquet.writer.version": "v2"}


def words(text: Column) -> Column:
    return split_words(ascii_lower(text), SEPARATORS)


def build_index(docs: DataFrame, work: Workspace, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Postings (term, doc_id, pos) of all tokens, each file sorted by term."""
    postings = (docs.where(F.col(id_col).isNotNull())
                .select(F.col(id_col).alias("doc_id"),
                        F.posexplode(words(F.col(text_col))).alias("pos", "word"))
                .select(F.xxhash64("word").alias("term"), "doc_id", "pos")
                .sortWithinPartitions("term"))
    return work.keep(postings, "postings", **INDEX_OPTIONS)


def benchmark_windows(items: DataFrame, size: int = WINDOW_WORDS, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """(item_id, words) of every window; an item of fewer words is one window."""
    w = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return (w.where(F.size("w") > 0)
            .select("item_id", "w", F.explode(starts).alias("s"))
            .select("item_id", F.slice("w", F.col("s"), F.lit(size)).alias("words")))


def _terms(phrases: DataFrame) -> DataFrame:
    return phrases.select("phrase", "words", F.posexplode("words").alias("off", "word")).select(
        "phrase", "off", F.xxhash64("word").alias("term"))


def _rarest_first(index: DataFrame, phrases: DataFrame,
                  work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(phrase, n, terms), the (term, off) pairs of each phrase, rarest first,
    and the postings of all their terms, for which the index is read once. A
    phrase with a term that the index lacks cannot occur and is left out."""
    wanted = work.keep(_terms(phrases).select("term").distinct(), "terms")
    index = work.keep(index.join(wanted, "term", "left_semi"), "wanted-postings", **INDEX_OPTIONS)
    frequency = work.keep(index.groupBy("term").count(), "frequencies")
    listed = F.array_sort(F.collect_list(F.struct("count", "off", "term")))
    ranked = (_terms(phrases).join(frequency, "term")
              .groupBy("phrase").agg(listed.alias("terms"))
              .join(phrases.select("phrase", F.size("words").alias("n")), "phrase")
              .where(F.size("terms") == F.col("n")))
    return ranked, index


def phrase_matches(index: DataFrame, docs: DataFrame, phrases: DataFrame, work: Workspace,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(phrase, doc_id, start, n) for every occurrence of each row of
    ``phrases`` (phrase: any long key, words: array of terms)."""
    k = INTERSECTED_TERMS
    ranked, index = _rarest_first(index, phrases, work)
    anchors = ranked.select(
        "phrase", "n",
        *[c for i in range(k) for c in (F.get("terms", F.lit(i))["term"].alias(f"term{i}"),
                                        F.get("terms", F.lit(i))["off"].alias(f"off{i}"))])
    anchors = work.keep(anchors, "anchors")
    found = (index.join(anchors, index["term"] == anchors["term0"])
             .select("phrase", "n", "doc_id", (F.col("pos") - F.col("off0")).alias("start"),
                     *[f"{c}{i}" for i in range(1, k) for c in ("term", "off")])
             .where("start >= 0"))
    for i in range(1, k):
        wanted = anchors.select(F.col(f"term{i}").alias("term")).distinct()
        lists = index.join(wanted, "term", "left_semi").select(
            F.col("term").alias("t"), F.col("doc_id").alias("d"), F.col("pos").alias("p"))
        at = ((F.col("t") == F.col(f"term{i}")) & (F.col("d") == F.col("doc_id"))
              & (F.col("p") == F.col("start") + F.col(f"off{i}")))
        longer = found.where(F.col(f"term{i}").isNotNull()).join(lists, at, "left_semi")
        found = longer.unionByName(found.where(F.col(f"term{i}").isNull()))
    spots = (found.groupBy("doc_id")
             .agg(F.collect_set(F.struct("phrase", "start", "n")).alias("spots")))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    here = (spots.join(texts, "doc_id")
            .select("doc_id", "spots", words(F.col("text")).alias("w"))
            .select("doc_id", F.explode(F.transform(
                "spots", lambda s: F.struct(
                    s["phrase"].alias("phrase"), s["start"].alias("start"), s["n"].alias("n"),
                    F.slice(F.col("w"), s["start"] + 1, s["n"]).alias("seen")))).alias("s"))
            .select("doc_id", "s.*"))
    return (here.join(phrases, "phrase").where(F.col("seen") == F.col("words"))
            .select("phrase", "doc_id", "start", "n").distinct())


def proximity_matches(index: DataFrame, phrases: DataFrame, within: int,
                      work: Workspace) -> DataFrame:
    """(phrase, doc_id, pos): places of a phrase's rarest term around which
    every other term of it occurs at most ``within`` words away, in any order.
    The distance join is an equi-join on position blocks of ``within`` words."""
    span = max(int(within), 1)
    ranked, index = _rarest_first(index, phrases, work)
    ranked = work.keep(ranked, "ranked")
    rarest = ranked.select("phrase", F.col("terms")[0]["term"].alias("term"))
    others = (ranked.select("phrase", F.col("terms")[0]["term"].alias("t0"),
                            F.explode("terms.term").alias("other"))
              .where(F.col("other") != F.col("t0")).select("phrase", "other").distinct())
    anchors = index.join(rarest, "term").select("phrase", "doc_id", "pos")
    needed = others.groupBy("phrase").agg(F.count("*").alias("needed"))
    near = (anchors.join(others, "phrase")
            .withColumn("block", F.explode(F.array(*[F.floor(F.col("pos") / span) + d
                                                     for d in (-1, 0, 1)]))))
    lists = (index.join(others.select(F.col("other").alias("term")).distinct(), "term", "left_semi")
             .select(F.col("term").alias("other"), F.col("doc_id").alias("d"),
                     F.col("pos").alias("p"), F.floor(F.col("pos") / span).alias("b")))
    at = [near["other"] == lists["other"], F.col("doc_id") == F.col("d"),
          F.col("block") == F.col("b"), F.abs(F.col("pos") - F.col("p")) <= within]
    met = (near.join(lists, at, "left_semi").select("phrase", "doc_id", "pos", "other").distinct()
           .groupBy("phrase", "doc_id", "pos").agg(F.count("*").alias("met"))
           .join(needed, "phrase").where("met = needed").select("phrase", "doc_id", "pos"))
    alone = rarest.join(needed, "phrase", "left_anti")
    return met.unionByName(index.join(alone, "term").select("phrase", "doc_id", "pos"))


def _words_hit(matches: DataFrame) -> DataFrame:
    """(doc_id, n_hit): words inside any match, by sweeping each document's
    matches in order of their start."""
    spans = matches.groupBy("doc_id", "start").agg(
        F.max(F.col("start") + F.col("n")).alias("end"))
    before = Window.partitionBy("doc_id").orderBy("start").rowsBetween(
        Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    return (spans.withColumn("reached", reached)
            .groupBy("doc_id")
            .agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "reached"), F.lit(0)))
                 .alias("n_hit")))


def decontaminate(docs: DataFrame, items: DataFrame, work: Workspace, size: int = WINDOW_WORDS,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated
    and items (the sorted ids of the benchmark items with a window in it)."""
    index = build_index(docs, work, id_col, text_col)
    windows = benchmark_windows(items, size, item_col, item_text_col)
    windows = work.keep(windows.withColumn("phrase", F.xxhash64("words")), "windows")
    phrases = work.keep(windows.groupBy("phrase").agg(F.min("words").alias("words")), "phrases")
    matches = work.keep(phrase_matches(index, docs, phrases, work, id_col, text_col), "matches")
    named = (matches.select("doc_id", "phrase").distinct()
             .join(windows.where(F.col("item_id").isNotNull())
                   .select("phrase", F.col("item_id").cast("string").alias("item")).distinct(),
                   "phrase")
             .groupBy("doc_id").agg(F.array_sort(F.collect_set("item")).alias("items")))
    lengths = index.groupBy("doc_id").agg(F.count("*").alias("n_words"))
    ids = docs.select(F.col(id_col).alias("doc_id")).where("doc_id is not null").distinct()
    empty = F.array().cast("array<string>")
    return (ids.join(lengths, "doc_id", "left").join(_words_hit(matches), "doc_id", "left")
            .join(named, "doc_id", "left")
            .withColumn("items", F.coalesce("items", empty))
            .select("doc_id",
                    F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
                    "items"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: all documents against all benchmark items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, items, Workspace(spark, "decontaminate")).drop("items")


# Windows are matched as whole word sequences between separators.
SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS gram,
         least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s
        FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
        FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT DISTINCT dw.doc_id, dw.s, dw.n, bw.item_id FROM dw JOIN bw USING (gram, n)),
pos AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(its.items, '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
