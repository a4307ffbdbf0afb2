"""Quality classifier: document evidence combined with site posteriors by
hierarchical empirical Bayes.

1. Every whole text gives a few form features (shares of characters by kind,
   repeated words, word and line lengths). A logistic regression, fitted on at
   most ``SAMPLE`` labelled documents (those with the smallest hash of their
   doc_id), turns them into the document's own probability of being good.
2. Grouped sums of those probabilities give each host (``source``) and each
   path below it (``source``, ``lang``) a Beta posterior. A host is shrunk
   toward the global mean, a path toward its host; the prior strengths are
   estimated from the spread between hosts and between paths (method of
   moments), so a site with few documents stays near its prior.
3. The score is the document's log-odds plus the log-odds by which its path's
   posterior, leaving the document itself out, differs from the global mean.
   Scores below 0 are rejected.

Every document is scored; sites are joined back by key, broadcast only when
the observed size of their table fits the limit, by shuffle otherwise.

Defined results: a null or empty text has all features 0; null source or lang
are sites of their own; labels that are null or of unknown documents are
ignored, a document labelled more than once is good when all its labels say
so; without labels of both kinds every document has probability 1 - 1e-6 and
is kept; repeated rows are scored alike; empty tables give empty results;
extra columns pass through ``keep`` untouched and are otherwise not read.
"""

from __future__ import annotations

from collections import namedtuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

from medallion.llm.common import table, written
from medallion.operators.sizing import ONE_SIDE_LIMIT, observe_profile, small_side

SAMPLE = 20_000
FLOOR = 1e-6
FEATURES = ["length", "symbols", "digits", "upper", "marks", "lines", "repeats", "word_length", "long_words"]

# The ASCII characters counted by each feature.
KINDS = {"symbols": b"#$%&*|<>{}[]@^~\\=+_/", "digits": b"0123456789", "upper": bytes(range(65, 91)),
         "marks": b".,;:!?", "lines": b"\n"}

Model = namedtuple("Model", "weights intercept")
Sites = namedtuple("Sites", "paths mean host_prior path_prior fits")


def text_features(text: str | None) -> list[float]:
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = [n[list(chars)].sum() / len(data) for chars in KINDS.values()]
    distinct = set(words)
    return [
        float(np.log1p(len(words))), *map(float, shares), 1 - len(distinct) / len(words),
        min(20.0, sum(map(len, words)) / len(words)), sum(len(w) > 20 for w in words) / len(words),
    ]


@pandas_udf(ArrayType(DoubleType()))
def features(text: pd.Series) -> pd.Series:
    return text.map(text_features)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _clip(p: Column) -> Column:
    return F.greatest(F.lit(FLOOR), F.least(F.lit(1 - FLOOR), p))


def evidence(feature: Column, model: Model) -> Column:
    """The document's own probability, from its feature array."""
    z = F.lit(model.intercept)
    for k, w in enumerate(model.weights):
        z = z + feature[k] * F.lit(w)
    return _clip(1 / (1 + F.exp(-z)))


def document_features(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("host"), F.col("lang").alias("path"),
        features(F.coalesce("text", F.lit(""))).alias("feature"),
    )


def fit(described: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Logistic regression on at most ``sample`` labelled documents."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").cast("double").alias("label"))
    rows = described.select("doc_id", "feature").dropDuplicates(["doc_id"]).join(good, "doc_id")
    rows = written(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).repartition(8), "quality_sample")
    if rows.select("label").distinct().count() < 2:
        return Model([0.0] * len(FEATURES), float(np.log((1 - FLOOR) / FLOOR)))
    fitted = LogisticRegression(regParam=1e-3, maxIter=50).fit(rows.select(array_to_vector("feature").alias("features"), "label"))
    return Model([float(w) for w in fitted.coefficients], float(fitted.intercept))


def _strength(groups: DataFrame, mean: Column, prior: Column) -> float:
    """Prior strength of a level: how many documents the prior is worth, from
    the spread of group means beyond what chance gives."""
    row = groups.agg(
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - prior, F.lit(2))).alias("between"),
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"), F.max(mean).alias("mean"),
    ).first()
    if not row["n"]:
        return 1.0
    v = row["mean"] * (1 - row["mean"])
    spread = max(0.0, (row["between"] - v * row["groups"]) / row["n"])
    return float(min(1e6, max(1.0, v / spread - 1))) if spread > 0 else 1e6


def fit_sites(scored: DataFrame) -> Sites:
    """Site table from (host, path, p): sums and counts by path and host."""
    paths = written(scored.groupBy("host", "path").agg(F.sum("p").alias("s"), F.count(F.lit(1)).alias("n")), "paths")
    total = paths.agg(F.sum("s"), F.sum("n")).first()
    mean = min(1 - FLOOR, max(FLOOR, total[0] / total[1])) if total[1] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    host_prior = _strength(hosts, F.lit(mean), F.lit(mean))
    hosts = hosts.select(F.col("host").alias("_h"), F.col("s").alias("host_s"), F.col("n").alias("host_n"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
    path_prior = _strength(both, F.lit(mean), F.col("host_s") / F.col("host_n"))
    observed, profile = observe_profile(both)
    both = written(observed, "sites")
    return Sites(both, mean, host_prior, path_prior, profile().fits(both, both.columns, ONE_SIDE_LIMIT))


def score(rows: DataFrame, host: str, path: str, p: Column, sites: Sites, prefix: str = "_q_") -> DataFrame:
    """``rows`` with ``{prefix}p / host / path / score`` added."""
    p_name, m = f"{prefix}p", F.lit(sites.mean)
    rows = rows.withColumn(p_name, p)
    s = sites.paths.select(*[F.col(c).alias(f"{prefix}t_{c}") for c in sites.paths.columns])
    s = small_side(s, sites.fits)
    joined = rows.join(
        s, rows[host].eqNullSafe(s[f"{prefix}t_host"]) & rows[path].eqNullSafe(s[f"{prefix}t_path"]), "left"
    )

    def t(name: str) -> Column:
        return F.col(f"{prefix}t_{name}")

    own = F.col(p_name)
    host_post = (F.lit(sites.host_prior) * m + t("host_s") - own) / (F.lit(sites.host_prior) + t("host_n") - 1)
    joined = joined.withColumn(f"{prefix}host", _clip(host_post))
    path_post = (F.lit(sites.path_prior) * F.col(f"{prefix}host") + t("s") - own) / (F.lit(sites.path_prior) + t("n") - 1)
    joined = joined.withColumn(f"{prefix}path", _clip(path_post))
    total = _logit(own) + _logit(F.col(f"{prefix}path")) - _logit(_clip(m))
    return joined.withColumn(f"{prefix}score", total)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, evidence, host_posterior, path_posterior, score, kept) for
    every row of ``docs``."""
    described = written(document_features(docs), "quality_features")
    model = fit(described, labels)
    p = evidence(F.col("feature"), model)
    sites = fit_sites(described.select("host", "path", p.alias("p")))
    out = score(described, "host", "path", p, sites)
    return out.select(
        "doc_id", F.col("_q_p").alias("evidence"), F.col("_q_host").alias("host_posterior"),
        F.col("_q_path").alias("path_posterior"), F.col("_q_score").alias("score"), (F.col("_q_score") >= 0).alias("kept"),
    )


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected. Texts are read again and
    scored where they are rather than shuffled to their decisions."""
    described = written(document_features(docs), "quality_features")
    model = fit(described, labels)
    sites = fit_sites(described.select("host", "path", evidence(F.col("feature"), model).alias("p")))
    rows = docs.withColumn("_q_f", features(F.coalesce("text", F.lit(""))))
    out = score(rows, "source", "lang", evidence(F.col("_q_f"), model), sites)
    return out.where("_q_score >= 0").select(*[docs[c] for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
