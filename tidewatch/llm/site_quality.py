"""Quality classifier: document evidence combined with host and path posteriors by hierarchical empirical Bayes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

TRAIN_ROWS = 20_000
FEATURES = 10
SYMBOLS = np.isin(np.arange(256), list(b"#$%&*|<>{}[]=_~^\\"))
UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90) | (np.arange(256) == 0xC3)
DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)


def features(text: str | None) -> list[float]:
    """Shares of kinds of characters and how much words and lines repeat; zeros for an empty text."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * FEATURES
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [x for x in data.split(b"\n") if x]
    caps = sum(w.isupper() for w in words) / len(words)
    n = len(data)
    return [
        float(counts[SYMBOLS].sum() / n), float(counts[UPPER].sum() / n), float(counts[DIGIT].sum() / n),
        float(counts[33] / n), float(counts[124] / n), caps, len(set(words)) / len(words),
        len(set(lines)) / len(lines), float(np.log(len(words))), n / len(words) / 10,
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-4, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, scale, weights with the bias last) of a logistic regression by Newton steps on squares too."""
    x = np.concatenate((x, x**2), axis=1)
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.concatenate(((x - centre) / scale, np.ones((len(x), 1))), axis=1)
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) / len(y) + decay * w
        bend = (z * (p * (1 - p))[:, None]).T @ z / len(y) + (decay + 1e-6) * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return centre, scale, w


def document_evidence(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, host_col: str, path_col: str, label_col: str = "quality", rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, host, path, p): the probability that the text alone is good.

    Learnt from at most `rows` labelled documents, picked by hash of the id;
    their features, a few numbers each, are all the driver sees. Without labels
    of both kinds p is 0.5.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                x = pa.array([features(t.as_py()) for t in part.column(3)], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], x], names=["doc_id", "host", "path", "x"])

    table = stored(given.mapInArrow(measured, f"doc_id {kind}, host string, path string, x array<double>"), "features")
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(F.col(label_col).cast("int")).alias("y"))
    known = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "quality-labels")
    sample = table.join(F.broadcast(known), "doc_id").select("doc_id", "x", "y").orderBy("doc_id", "x").collect()
    y = np.array([r["y"] for r in sample], float)
    if len(set(y.tolist())) < 2:
        return table.select("doc_id", "host", "path", F.lit(0.5).alias("p"))
    centre, scale, w = (a.tolist() for a in fit_logistic(np.array([r["x"] for r in sample]), y))
    x = [F.element_at("x", i % FEATURES + 1) for i in range(2 * FEATURES)]
    x = [c if i < FEATURES else c * c for i, c in enumerate(x)]
    raw = sum(((c - m) / s * k for c, m, s, k in zip(x, centre, scale, w)), F.lit(w[-1]))
    return table.select("doc_id", "host", "path", (1 / (1 + F.exp(-F.greatest(F.least(raw, F.lit(30.0)), F.lit(-30.0))))).alias("p"))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def site_quality(evidence: DataFrame, prior_rows: float = 1.0, weight: float = 0.5, threshold: float = 0.3) -> DataFrame:
    """(doc_id, host, path, document_p, host_p, path_p, score, keep) for every row of evidence (doc_id, host, path, p).

    A host's posterior is (strength * global mean + its sum of p) / (strength +
    its rows), a path's the same around its host's. The strengths are those of
    a beta prior whose variance is that seen between hosts, or between the
    paths of hosts, beyond chance; sites that hardly differ get large ones. The
    score adds `weight` times the path's lead over the global mean, in logits.

    Null hosts and paths are sites of their own. Site sums are partly summed
    before they are shuffled; nothing else of a hot host meets in a task.
    """
    paths = evidence.groupBy("host", "path").agg(F.sum("p").alias("good"), F.count(F.lit(1)).alias("n"))
    paths = stored(paths, "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("n").alias("host_n")), "hosts")
    whole = hosts.agg(F.coalesce(F.sum("host_good") / F.sum("host_n"), F.lit(0.5)).alias("mean")).first()
    mean = min(max(whole["mean"], 1e-6), 1 - 1e-6)

    def strength(table: DataFrame, good: str, n: str, centre: Column) -> float:
        """Rows the prior is worth: mean (1 - mean) / variance between sites, less the variance chance brings."""
        share = F.col(good) / F.col(n)
        row = table.agg(F.sum(F.col(n) * (share - centre) ** 2).alias("v"), F.sum(n).alias("n"), F.count(F.lit(1)).alias("sites")).first()
        if not row["n"] or row["sites"] < 2:
            return prior_rows
        chance = mean * (1 - mean) * row["sites"] / row["n"]
        between = max(row["v"] / row["n"] - chance, 1e-6)
        return max(prior_rows, mean * (1 - mean) / between - 1)

    at_hosts = strength(hosts, "host_good", "host_n", F.lit(mean))
    hosts = hosts.withColumn("host_p", (at_hosts * mean + F.col("host_good")) / (at_hosts + F.col("host_n")))
    hosts = hosts.select(F.col("host").alias("_host"), "host_p")
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    at_paths = strength(paths, "good", "n", F.col("host_p"))
    paths = paths.withColumn("path_p", (at_paths * F.col("host_p") + F.col("good")) / (at_paths + F.col("n")))
    paths = paths.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "host_p", "path_p")
    both = F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))
    lead = _logit(F.col("path_p")) - float(np.log(mean / (1 - mean)))
    score = 1 / (1 + F.exp(-(_logit(F.col("p")) + weight * lead)))
    found = evidence.join(paths, both).withColumn("score", score)
    return found.select("doc_id", "host", "path", F.col("p").alias("document_p"), "host_p", "path_p", "score", (F.col("score") >= threshold).alias("keep"))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", **params) -> DataFrame:
    """`site_quality` of `docs`; null and empty texts have the probability of a text without features."""
    evidence = stored(document_evidence(docs, labels, id_col, text_col, host_col, path_col), "evidence")
    return site_quality(evidence, **params)
