"""Language identification by Bayesian evidence fusion.

The posterior of a language is the product of independent pieces of evidence:

* the text: hashed byte trigrams under a multinomial model per language, and a
  uniform model for "und" (text that is none of the languages). Overlapping
  trigrams are not independent, so the log likelihood is tempered;
* the declared language (markup, metadata), which is right with probability
  ``DECLARED``;
* the address suffix of a country (``SUFFIXES``), right with ``SUFFIX``;
* the host's prior: how often each language was found on the host, smoothed
  towards its registered domain, that towards all rows, and that towards uniform
  (``STRENGTH`` pseudo-rows a level). The counts come from grouped aggregation
  of a first decision on text and declaration, over all rows; partial sums per
  task make a host with a third of all rows no hot task.

The text model is fitted on at most ``SAMPLE`` labelled documents a language,
those of the smallest id hashes, whole texts.

Defined cases: rows without any letter have no text evidence and are "und";
null declarations, addresses and hosts are no evidence (a null host is a host
of its own); every input row gives one output row; an empty training table
leaves "und" alone; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.llm.common import Workspace, give_back, ship_package

UNKNOWN = "und"
SAMPLE = 300
# Languages of a model, at most.
LANGUAGES = 200
BUCKETS = 1 << 15
SMOOTHING = 0.05
TEMPER = 1 / 3
DECLARED = 0.9
SUFFIX = 0.8
STRENGTH = 10.0
# Country suffixes that speak for a language (fixed values).
SUFFIXES = {"at": "de", "be": "fr", "ch": "de", "de": "de", "es": "es", "fr": "fr", "mx": "es",
            "uk": "en", "us": "en"}

_LETTERS = re.compile(r"[^\W\d_]+")
# Elements whose content is no text: how they begin, and how each ends.
_HIDDEN = re.compile(r"(?i)<(script|style)\b")
_HIDDEN_END = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style")}
_DECLARATION = r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)"
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]+)"


def markup_text(markup: str) -> str:
    """The text between tags, without comments, scripts and styles. One that is
    not closed hides only its first tag. An end that was once looked for in vain
    is not looked for again, so the time is linear in the length."""
    kept, at, missing = [], 0, set()

    def end_of(kind: str, find) -> int:
        """The place after an end, -1 if there is none."""
        if kind in missing:
            return -1
        place = find()
        if place < 0:
            missing.add(kind)
        return place

    while (start := markup.find("<", at)) >= 0:
        kept.append(markup[at:start])
        stop = -1
        if markup.startswith("<!--", start):
            stop = end_of("-->", lambda: place + 3 if (
                place := markup.find("-->", start + 4)) >= 0 else -1)
        elif hidden := _HIDDEN.match(markup, start):
            kind = hidden[1].lower()
            stop = end_of(kind, lambda: found.end() if (
                found := _HIDDEN_END[kind].search(markup, start)) else -1)
        if stop < 0:
            stop = end_of(">", lambda: (markup.find(">", start) + 1) or -1)
        if stop < 0:
            at = start
            break
        kept.append(" ")
        at = stop
    kept.append(markup[at:])
    return html.unescape("".join(kept))


def _trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the text's letters; anything else is a blank."""
    words = _LETTERS.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint32)
    data = np.frombuffer(f" {' '.join(words)} ".encode(), np.uint8).astype(np.uint32)
    mixed = (data[:-2] * np.uint32(65599) + data[1:-1]) * np.uint32(65599) + data[2:]
    return (mixed * np.uint32(2654435761)) >> np.uint32(32 - 15)


class Model:
    """Log probabilities of the trigram buckets: a row per language, the last
    for "und"."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    def likelihoods(self, text: str | None) -> list[float] | None:
        grams = _trigrams(text or "")
        if not len(grams):
            return None
        return (self.table[:, grams].sum(axis=1) * TEMPER).tolist()


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        sample: int = SAMPLE) -> Model:
    """The model of a bounded sample of the ``LANGUAGES`` most frequent declared
    languages (ties by name); what reaches the driver is one number per language
    and bucket. The sampled ids are written first, so that Spark knows how few
    they are and does not move the texts to find theirs."""
    work = Workspace(docs.sparkSession, "language-fit")
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    frequent = work.keep(docs.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang"))
                         .count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang"),
                         "languages")
    some = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"),
                        F.xxhash64(F.col(id_col)).alias("h"))
            .where("lang is not null and doc_id is not null").join(frequent, "lang", "left_semi")
            .withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample)
            .select("doc_id", "lang"))
    some = work.keep(some, "sample")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, np.ndarray] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                np.add.at(counts[lang], _trigrams(text or ""), 1)
            for lang, n in counts.items():
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()),
                     pa.array(n[seen], pa.int64())], schema=schema)

    counted = (texts.join(some, "doc_id").select("lang", "text")
               .mapInArrow(give_back(run), "lang string, gram int, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(counted["lang"].unique())
    table = np.full((len(languages) + 1, BUCKETS), SMOOTHING)
    for row, lang in enumerate(languages):
        part = counted[counted["lang"] == lang]
        np.add.at(table[row], part["gram"].to_numpy(), part["n"].to_numpy())
    return Model([*languages, UNKNOWN], np.log(table / table.sum(axis=1, keepdims=True)))


def text_evidence(rows: DataFrame, model: Model, key: str, text: Column, declared: Column,
                  host: Column, is_markup: bool = False) -> DataFrame:
    """(key, declared, host, evidence): evidence is a log likelihood per
    language of the model, null without letters."""
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS numbers
    schema = pa.schema([("key", pa.int64()), ("declared", pa.string()), ("host", pa.string()),
                        ("evidence", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(3):
                content = value.as_py()
                if content is not None and is_markup:
                    content = markup_text(content)
                found.append(shared.value.likelihoods(content))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, pa.list_(pa.float64()))], schema=schema)

    return (rows.select(F.col(key).cast("long").alias("key"), declared.alias("declared"),
                        host.alias("host"), text.alias("text"))
            .mapInArrow(give_back(run), "key long, declared string, host string, evidence array<double>"))


def _agrees(found: Column, languages: list[str], right: float) -> list[Column]:
    """Log likelihood per language of a statement that is right with a given
    probability; a statement of no known language is no evidence."""
    known = [x for x in languages if x != UNKNOWN]
    wrong = (1 - right) / max(len(known) - 1, 1)
    return [F.when(found.isin(known), F.log(F.lit(1 / max(len(known), 1))) if x == UNKNOWN
                   else F.log(F.when(found == x, right).otherwise(wrong))).otherwise(0.0)
            for x in languages]


def _sum(*parts: list[Column]) -> Column:
    return F.array(*[sum(column[1:], column[0]) for column in zip(*parts)])


def _best(scores: str, languages: list[str]) -> Column:
    names = F.array(*[F.lit(x) for x in languages])
    return F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))


def identify(evidence: DataFrame, model: Model, work: Workspace) -> DataFrame:
    """(key, lang, confidence, declared, host) of evidence rows."""
    languages = model.languages
    n = len(languages)
    rows = work.keep(evidence, "evidence")
    text = [F.coalesce(F.get("evidence", F.lit(i)), F.lit(0.0)) for i in range(n)]
    labels = F.split(F.lower(F.coalesce("host", F.lit(""))), r"\.")
    suffix = F.element_at(labels, -1)
    table = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])
    said = [text, _agrees(F.lower("declared"), languages, DECLARED),
            _agrees(F.get(F.map_values(F.map_filter(table, lambda k, _: k == suffix)), F.lit(0)),
                    languages, SUFFIX)]
    rows = rows.withColumn("scores", _sum(*said)).withColumn(
        "domain", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), "."))
    letters = F.col("evidence").isNotNull()
    first = rows.where(letters).select("host", "domain", _best("scores", languages).alias("lang"))
    counts = work.keep(first.groupBy("host", "domain", "lang").agg(F.count("*").alias("n")), "counts")

    def per_level(*keys: str) -> DataFrame:
        return counts.groupBy(*keys).agg(F.array(*[
            F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)), F.lit(0))
            .cast("double")
            for x in languages]).alias("c"))

    def smoothed(own: str, above: Column) -> Column:
        total = F.aggregate(own, F.lit(0.0), lambda t, x: t + x)
        return F.zip_with(own, above, lambda x, p: (x + STRENGTH * p) / (total + STRENGTH))

    uniform = F.array(*[F.lit(1.0 / n)] * n)
    every = per_level().select(smoothed("c", uniform).alias("p")).first()["p"]  # a number per language
    overall = F.array(*[F.lit(float(p)) for p in every])
    domains = per_level("domain").select("domain", smoothed("c", overall).alias("above"))
    hosts = (per_level("host", "domain").join(domains, "domain")
             .select(F.col("host").alias("at"), smoothed("c", F.col("above")).alias("prior")))
    hosts = work.keep(hosts, "hosts")
    fused = F.zip_with("scores", F.coalesce("prior", overall), lambda s, p: s + F.log(p))
    joined = (rows.join(hosts, F.col("host").eqNullSafe(F.col("at")), "left")
              .withColumn("fused", fused))
    odds = F.aggregate("fused", F.lit(0.0), lambda t, x: t + F.exp(x - F.array_max("fused")))
    return joined.select(
        "key", F.when(letters, _best("fused", languages)).otherwise(UNKNOWN).alias("lang"),
        F.when(letters, 1 / odds).otherwise(0.0).alias("confidence"), "declared", "host")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: all pages, by their text, markup, address and host."""
    work = Workspace(spark, "language")
    model = fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    declared = F.lower(F.nullif(F.regexp_extract("html", _DECLARATION, 1), F.lit("")))
    host = F.nullif(F.lower(F.regexp_extract("url", _HOST, 1)), F.lit(""))
    evidence = text_evidence(pages, model, "page_id", F.col("html"), declared, host, is_markup=True)
    return identify(evidence, model, work).withColumnRenamed("key", "page_id")
