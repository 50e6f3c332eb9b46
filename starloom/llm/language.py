"""Language ID by Bayesian evidence fusion.

For each row and language, four pieces of evidence are added as logarithms: the likelihood of the text (a naive Bayes model of
byte trigrams), the likelihood of the language declared in the markup, that of the address suffix, and a prior of the
host. Text likelihoods are averaged over trigrams and weighted as at most ``TEXT_WEIGHT`` of them, since neighbours are
not independent. The other three are learned from all rows by grouped aggregation of the text posteriors: how often each
declaration or suffix goes with each language, and how the languages of a host are spread. Host counts are smoothed towards their
domain's, the domain's towards those of all rows (``SMOOTH`` pseudo-rows a level); a row's own share is taken out of its
host's and domain's counts first.

The text model is fitted on a sample of the labelled documents, the only bounded one here: those whose digest of id, label and text falls under
a share of their label. The share is SAMPLE / rows, or QUOTA / rows of the label where that is more, so about ``SAMPLE`` documents and ``QUOTA``
more for each rare label; labels are counted over all rows, and one of QUOTA rows or fewer gives all of them. Only rows equal in
all three go together. A label is left out if none of its documents taken holds a letter trigram.

Without any labelled document nothing can be told: every row has language NULL and confidence 0, and ``keep_identified`` rejects nothing.

Defined results: a row without any letter trigram (NULL, empty, digits, symbols) has language NULL and confidence 0: rejected. So is a row whose
best language has a posterior under ``accept``. NULL or unparsable addresses, and NULL declarations, are values of their own; repeated rows give equal rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import free_name, read, utf8
from starloom.session import cut_lineage

SAMPLE = 4000
QUOTA = 200
BUCKETS = 1 << 15
TEXT_WEIGHT = 100.0
SMOOTH = 10.0
ACCEPT = 0.5

_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))
#: What is not text. Whatever is not closed ends at the next tag or, as in HTML, at the page's end, so each place is looked at once.
_SKIP = r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>"


def trigrams(data: bytes | None) -> np.ndarray:
    """Buckets of the byte trigrams of ``data``, letters made small, runs of other ASCII as one blank."""
    if not data:
        return np.empty(0, np.int64)
    folded = data.decode("utf-8", "replace").lower().encode().translate(_LETTERS)
    b = np.frombuffer(b" " + b" ".join(folded.split()) + b" ", np.uint8).astype(np.int64)
    if len(b) < 3:
        return np.empty(0, np.int64)
    x = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((x * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - 15)


def fit_text_model(labelled: DataFrame, sample: int = SAMPLE, quota: int = QUOTA) -> tuple[list[str], np.ndarray]:
    """Languages and log P(trigram | language) from (id, text, lang) rows."""
    def count(batches):
        for b in batches:
            langs, table = b.column(1).to_pylist(), {}
            for data, lang in zip(utf8(b.column(0)), langs):
                table.setdefault(lang, np.zeros(BUCKETS, np.int64))
                table[lang] += np.bincount(trigrams(data), minlength=BUCKETS)
            out = [(lang, int(i), int(t[i])) for lang, t in table.items() for i in np.nonzero(t)[0]]
            yield pa.record_batch([pa.array(x) for x in zip(*out)] if out else
                                  [pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.int64())],
                                  ["lang", "bucket", "n"])
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    of = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}  # one number a language
    even = sample / max(1, sum(of.values()))
    rare = {lang: quota / n for lang, n in of.items() if quota / n > even}
    share = F.lit(even)
    if rare:
        share = F.coalesce(F.create_map(*[F.lit(x) for pair in sorted(rare.items()) for x in pair])[F.col("lang")], share)
    place = F.pmod(F.xxhash64(F.col("id").cast("string"), "lang", "text"), F.lit(1 << 40)) / float(1 << 40)
    taken = usable.filter(place < share).select("text", "lang")
    rows = (taken.mapInArrow(count, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())  # languages x BUCKETS at most
    langs = sorted({r.lang for r in rows})
    counts = np.full((max(1, len(langs)), BUCKETS), 0.5)
    for r in rows:
        counts[langs.index(r.lang), r.bucket] += r.n
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()


def _text_scores(rows: DataFrame, text_col: str, langs: list[str], table: np.ndarray) -> DataFrame:
    model = rows.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("array<double>")
    def score(texts: pa.Array) -> pa.Array:
        out = []
        for data in utf8(texts):
            x = trigrams(data)
            if not len(x) or not langs:
                out.append(None)
                continue
            s = sum((model.value[x[i:i + 65536]].sum(axis=0, dtype=np.float64) for i in range(0, len(x), 65536)), np.zeros(len(langs)))
            s = (s - s.max()) / len(x) * min(len(x), TEXT_WEIGHT)
            out.append(s.tolist())
        return pa.array(out, pa.list_(pa.float64()))
    return rows.withColumn("text_score", score.asNondeterministic()(F.col(text_col)))


def _posterior(scores: np.ndarray) -> np.ndarray:
    x = np.exp(scores - scores.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    """A list column of n numbers a row; NULL lists are zeros."""
    return np.array([x if x is not None else [0.0] * n for x in column.to_pylist()], np.float64).reshape(-1, n)


def identify(rows: DataFrame, langs: list[str], table: np.ndarray, accept: float = ACCEPT) -> DataFrame:
    """``rows`` has id, text, declared, suffix, domain, host (any NULL); result: every column but text, language, confidence.

    Language is NULL where no language reaches ``accept``.
    """
    n = len(langs)
    if not n:
        return rows.drop("text").withColumns({"language": F.lit(None).cast("string"), "confidence": F.lit(0.0)})
    scored = _text_scores(rows, "text", langs, table).drop("text")

    @F.arrow_udf("array<double>")
    def alone(scores: pa.Array) -> pa.Array:
        p = _posterior(_matrix(scores, n)) * np.array([[x.is_valid] for x in scores], float).reshape(-1, 1)
        return pa.array(p.tolist(), pa.list_(pa.float64()))
    soft = cut_lineage(scored.withColumn("own", alone(F.col("text_score"))), "language-scores")
    sums = F.array(*[F.sum(F.col("own")[i]) for i in range(n)])
    joined = soft
    for key in ("host", "domain", "declared", "suffix"):
        g = soft.groupBy(F.col(key).alias("_key")).agg(sums.alias(f"of_{key}"))
        joined = joined.join(g, joined[key].eqNullSafe(g["_key"]), "left").drop("_key")
    whole = _matrix(pa.array([soft.agg(sums.alias("x")).first().x or [0.0] * n]), n)[0]  # n numbers
    whole = np.nan_to_num(whole)
    values = {key: soft.agg(F.approx_count_distinct(key)).first()[0] + 1 for key in ("declared", "suffix")}
    base = (whole + 1.0) / (whole.sum() + n)

    @F.arrow_udf("array<double>")
    def fuse(scores: pa.Array, own: pa.Array, host: pa.Array, domain: pa.Array, declared: pa.Array,
             suffix: pa.Array) -> pa.Array:
        own = _matrix(own, n)
        others = lambda c: np.maximum(_matrix(c, n) - own, 0.0)  # noqa: E731  without the row itself
        prior = np.tile(base, (len(own), 1))
        for counts in (others(domain), others(host)):
            prior = (counts + SMOOTH * prior) / (counts.sum(axis=1, keepdims=True) + SMOOTH)
        total = _matrix(scores, n) + np.log(prior)
        for key, c in (("declared", declared), ("suffix", suffix)):
            total += np.log((others(c) + 1.0) / (whole + values[key]))
        p = _posterior(total)
        return pa.array([x if s.is_valid else None for x, s in zip(p.tolist(), scores)], pa.list_(pa.float64()))
    fused = joined.withColumn("posterior", fuse.asNondeterministic()(
        "text_score", "own", "of_host", "of_domain", "of_declared", "of_suffix"))
    confidence = F.coalesce(F.array_max("posterior"), F.lit(0.0))
    place = F.array_position("posterior", F.array_max("posterior")).cast("int")
    name = F.element_at(F.array(*[F.lit(x) for x in langs]), place)
    return fused.select(*[c for c in rows.columns if c != "text"],
                        F.when(confidence >= accept, name).alias("language"), confidence.alias("confidence"))


def address_parts(url):
    """Host, domain (last two labels) and suffix (last label) of an address; NULL where there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    host = F.when(found != "", found)
    return host, F.substring_index(host, ".", -2), F.substring_index(host, ".", -1)


def identify_pages(pages: DataFrame, langs, table, accept: float = ACCEPT) -> DataFrame:
    """page_id, url, declared, host, language, confidence of (page_id, url, html) rows."""
    declared = F.lower(F.regexp_extract("html", r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    host, domain, suffix = address_parts(F.col("url"))
    rows = pages.select(
        F.col("page_id").alias("id"), "url", F.when(declared != "", declared).alias("declared"), host.alias("host"),
        domain.alias("domain"), suffix.alias("suffix"), F.regexp_replace("html", _SKIP, " ").alias("text"))
    return (identify(rows, langs, table, accept).withColumnRenamed("id", "page_id")
            .select("page_id", "url", "declared", "host", "language", "confidence"))


def text_model(spark, sf_dir) -> tuple[list[str], np.ndarray]:
    return fit_text_model(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang"))


def keep_identified(docs: DataFrame, langs: list[str], table: np.ndarray, accept: float = ACCEPT,
                    text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` without those whose language stays open; the source stands for the host, the lang column for the markup's.

    The input is given a row number and written once, so that the decision, made on narrow rows, finds its document
    whatever its id (NULL and repeated ids included). Without a model (no labels) no language can be open: all are kept.
    """
    if not langs:
        return docs
    row = free_name(docs, "language_row")
    held = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()), "language-docs")
    rows = held.select(F.col(row).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("declared"),
                       F.col(source_col).alias("host"), F.lit(None).cast("string").alias("domain"),
                       F.lit(None).cast("string").alias("suffix"))
    kept = identify(rows, langs, table, accept).filter(F.col("language").isNotNull()).select(F.col("id").alias(row))
    return held.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_language(spark, sf_dir):
    langs, table = text_model(spark, sf_dir)
    return identify_pages(read(spark, sf_dir, "pages"), langs, table)
