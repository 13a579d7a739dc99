"""Language identification of pages by fusing Bayesian evidence.

1. Text: log-likelihood of each language under byte trigrams, counted over all
   labelled documents.  Neighbouring trigrams tell much the same, so their sum
   is tempered by ``TEMPER``.
2. Declared markup language: how often pages of a language declare which one.
3. Address suffix: how often pages of a language have which top-level suffix.
4. Host prior: languages of the host's pages, smoothed towards those of its
   domain, and these towards those of all pages.

2 to 4 are sums of the text's probabilities over all pages, grouped by Spark;
a page's own part is taken out of the sums before they judge it.  The
posterior is their product with the text's likelihood.

Defined cases: a null or empty page has no text and is judged by its address
and declaration, or by the general rates; a null URL or one without "://" has
an empty host; without labelled documents the language is null; ties go to
the first language in order; repeated rows are judged each; further columns
are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import batch, stored, strings
from seawake.llm.urls import host_of

TEMPER = 0.1
SMOOTH = 0.5
HOST_WEIGHT = 10.0
MARKUP_WEIGHT = 2.0
BUCKETS = 1 << 16
_GONE = re.compile(r"(?is)<!--.*?-->|<(script|style|nav|footer|template|noscript|svg)\b.*?</\1\s*>|<div class=\"?ad\b.*?</div>|<[^>]*>")
_DECLARED = re.compile(r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b")
_JUNK = re.compile(r"[\W\d_]+")


def page_text(page: str) -> str:
    """Running text of a page, without markup, scripts, navigation and footers."""
    return entities.unescape(_GONE.sub(" ", page))


def declared_language(page: str) -> str:
    """Primary subtag that the page declares, or the empty string."""
    found = _DECLARED.search(page)
    return found[1].lower() if found else ""


def trigrams(text: str) -> np.ndarray:
    """Buckets of byte trigrams of the letters; words are set apart by one space."""
    data = np.frombuffer((" " + _JUNK.sub(" ", text.lower()).strip() + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
    if len(data) < 4:
        return np.zeros(0, np.int64)
    return ((data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * 0x9E3779B1 & 0xFFFFFFFF) >> 16


def trigram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, bucket, n over whole texts of all labelled documents; partial sums leave each task."""
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(strings(b.column(0)), b.column(1).to_pylist(), strict=True):
                own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigrams(text), minlength=BUCKETS)
                if len(sums) > 64:  # few languages are held at once
                    yield from out(sums)
                    sums = {}
        yield from out(sums)

    def out(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield batch(schema, [lang] * len(at), at, own[at])

    rows = docs.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string").alias("l")).filter("l is not null")
    return rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def text_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and log-probabilities of buckets: at most BUCKETS numbers for each language."""
    counts: dict[str, np.ndarray] = {}
    for r in trigram_counts(docs, text_col, lang_col).toLocalIterator():
        counts.setdefault(r["lang"], np.zeros(BUCKETS))[r["bucket"]] = r["n"]
    languages = sorted(counts)
    table = np.stack([counts[x] for x in languages], axis=1) + SMOOTH if languages else np.zeros((BUCKETS, 0))
    return languages, np.log(table / table.sum(axis=0)).astype(np.float32)


def _softmax(x: Column) -> Column:
    top = F.array_max(x)
    powers = F.transform(x, lambda v: F.exp(v - top))
    return F.transform(powers, lambda v: v / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def _sums(rows: DataFrame, keys: list[str], size: int, name: str) -> DataFrame:
    """Sums of the text's probabilities, as one array for each key."""
    parts = [F.sum(F.element_at("p", i + 1)).alias(f"s{i}") for i in range(size)]
    return rows.groupBy(*keys).agg(*parts).select(*keys, F.array(*[f"s{i}" for i in range(size)]).alias(name))


def languages_of(
    pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", lang_col: str = "lang"
) -> DataFrame:
    """One row per page: id, lang, probability, and the evidence (text_lang, declared, suffix, host)."""
    spark = pages.sparkSession
    languages, table = text_model(docs, lang_col=lang_col)
    size = len(languages)
    shared = spark.sparkContext.broadcast(table)
    schema = pa.schema([("id", pa.int64()), ("host", pa.string()), ("declared", pa.string()), ("likelihood", pa.list_(pa.float64()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = strings(b.column(2))
            sums = [shared.value[trigrams(page_text(x))].sum(axis=0, dtype=np.float64) * TEMPER for x in bodies]
            yield batch(schema, b.column(0), b.column(1), [declared_language(x) for x in bodies], [(x - x.max()).tolist() if size else [] for x in sums])

    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long"), host_of(url), F.col(html_col).cast("string"))
    rows = rows.mapInArrow(read, "id long, host string, declared string, likelihood array<double>")
    if not size:
        none = F.lit(None).cast("string").alias("lang")
        return rows.select(F.col("id").alias(id_col), none, F.lit(None).cast("double").alias("probability"), none.alias("text_lang"), "declared", "host")
    suffix = F.element_at(F.split("host", r"\."), -1)
    labels = F.split("host", r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    rows = rows.select("*", suffix.alias("suffix"), domain.alias("domain"), _softmax(F.col("likelihood")).alias("p"))
    rows = stored(rows, "page-evidence")

    total = _sums(rows, [], size, "total").first()["total"]
    total = [x or 0.0 for x in total]
    rate = [(x + SMOOTH) / (sum(total) + SMOOTH * size) for x in total]
    hosts = _sums(rows, ["host", "domain"], size, "by_host")
    domains = _sums(rows, ["domain"], size, "by_domain")
    hosts = stored(hosts.join(domains, "domain").select("host", "by_host", "by_domain"), "page-hosts")
    declared = stored(_sums(rows, ["declared"], size, "by_declared"), "page-declared")
    suffixes = stored(_sums(rows, ["suffix"], size, "by_suffix"), "page-suffixes")
    own = lambda sums, i: F.greatest(F.element_at(sums, i + 1) - F.element_at("p", i + 1), F.lit(0.0))
    mass = lambda sums: F.aggregate(F.col(sums), F.lit(0.0), lambda a, b: a + b) - 1

    def evidence(i: int) -> Column:
        by_domain = (own("by_domain", i) + HOST_WEIGHT * rate[i]) / (F.greatest(mass("by_domain"), F.lit(0.0)) + HOST_WEIGHT)
        prior = (own("by_host", i) + HOST_WEIGHT * by_domain) / (F.greatest(mass("by_host"), F.lit(0.0)) + HOST_WEIGHT)
        # what is declared, or the suffix, given the language: its share, smoothed towards its share of all pages
        given = [
            (own(s, i) + MARKUP_WEIGHT * (mass(s) + 1) / sum(total)) / (max(total[i], 0.0) + MARKUP_WEIGHT) for s in ("by_declared", "by_suffix")
        ]
        return F.element_at("likelihood", i + 1) + F.log(prior) + F.log(F.greatest(given[0], F.lit(1e-9))) + F.log(F.greatest(given[1], F.lit(1e-9)))

    joined = rows.join(hosts, "host").join(declared, "declared").join(suffixes, "suffix")
    joined = joined.select("*", F.array(*[evidence(i) for i in range(size)]).alias("evidence"))
    joined = joined.select("*", _softmax(F.col("evidence")).alias("posterior"))
    names = F.array(*[F.lit(x) for x in languages])
    first = lambda values: F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))
    return joined.select(
        F.col("id").alias(id_col),
        first(F.col("posterior")).alias("lang"),
        F.array_max("posterior").alias("probability"),
        first(F.col("likelihood")).alias("text_lang"),
        "declared",
        "host",
    )
