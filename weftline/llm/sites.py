"""Document quality by hierarchical empirical Bayes.

A linear classifier over the shape of a text (signs, capitals, repeats, lengths) gives each document a
probability of good quality.  Hosts, and the paths below them, get a posterior from the probabilities of their
documents: a path shrinks towards its host and a host towards the whole corpus, the more the fewer documents
it has.  How strongly they shrink is estimated from how much the sites really differ.  The document's own
evidence is left out of its site's posterior, and the two are added as log odds.

The classifier is fitted on the driver on at most ``sample`` labelled documents, drawn by a hash of the id;
all sums over sites are grouped aggregations over all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import ASCII_PUNCTUATION, binary_texts, map_in_arrow, whole_row
from weftline.llm.logistic import Sparse, fit_logistic
from weftline.session import stored

SHAPES = (
    "log_words", "mean_length", "symbols", "punctuation", "digits", "capitals", "distinct", "top_word",
    "repeated_lines", "words_per_line", "long_words", "empty",
)
SYMBOLS = b"#*$%&|<>{}[]^~=_+@\\"
CAPITALS = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
STRONGEST = 1e4


def shape(text: bytes | None) -> list[float]:
    """The features of ``SHAPES``; a text without words has nothing but ``empty``."""
    words = (text or b"").split()
    if not words:
        return [0.0] * (len(SHAPES) - 1) + [1.0]
    size, n = len(text), len(words)
    share = [(size - len(text.translate(None, signs))) / size for signs in (SYMBOLS, ASCII_PUNCTUATION, DIGITS, CAPITALS)]
    counts = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        np.log1p(n), sum(map(len, words)) / n, *share, len(counts) / n, counts.most_common(1)[0][1] / n,
        1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), sum(len(w) > 20 for w in words) / n, 0.0,
    ]


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shape(text) for text in binary_texts(batch.column("text"))]
        names = ["row", "doc", "host", "path"]
        yield pa.RecordBatch.from_arrays(
            [*map(batch.column, names), pa.array(found, pa.list_(pa.float64()))], [*names, "shape"]
        )


def fit_weights(seen: DataFrame, labels: DataFrame, sample: int, seed: int = 42) -> tuple[list[float], float]:
    """(weight of each shape and the bias, share of good documents among the labelled ones).

    Several powers of a feature are not needed: features are scaled to zero mean and unit deviation, and
    their squares join them, so that both ends of a range can be bad.
    """
    marks = labels.select(F.col("doc_id").alias("doc"), F.col("quality").cast("double").alias("good")).dropna()
    draw = F.xxhash64(F.lit(seed), "doc", "good")
    number = F.row_number().over(Window.orderBy("draw"))  # of at most ``sample`` rows
    drawn = marks.withColumn("draw", draw).orderBy("draw").limit(sample).withColumn("number", number)
    each = seen.join(F.broadcast(drawn), "doc").groupBy("number", "draw", "good").agg(F.min("shape").alias("shape"))
    rows = each.select("draw", "good", "shape").collect()
    rows.sort(key=lambda r: (r["draw"], r["shape"]))
    if not rows:
        return [0.0] * (2 * len(SHAPES) + 1), 0.5
    x, y = np.array([r["shape"] for r in rows]), np.array([r["good"] for r in rows])
    mean, deviation = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    scaled = (x - mean) / deviation
    dense = np.clip(np.column_stack([scaled, scaled**2]), -20.0, 20.0)
    weights = fit_logistic(Sparse([[]] * len(rows), 0, dense), y, rounds=400)
    return [*weights.tolist(), *mean.tolist(), *deviation.tolist()], float(y.mean())


def _log_odds(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def _probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(log_odds, F.lit(30.0)), F.lit(-30.0))))


def _score(values: list[float]) -> Column:
    """The classifier's log odds for the column ``shape``."""
    k = len(SHAPES)
    if len(values) < 4 * k + 1:
        return F.lit(0.0)
    weights, bias, mean, deviation = values[: 2 * k], values[2 * k], values[2 * k + 1 : 3 * k + 1], values[3 * k + 1 :]

    def clipped(x: Column) -> Column:
        return F.greatest(F.least(x, F.lit(20.0)), F.lit(-20.0))

    total = F.lit(bias)
    for i in range(k):
        scaled = (F.col("shape")[i] - mean[i]) / deviation[i]
        total = total + clipped(scaled) * weights[i] + clipped(scaled * scaled) * weights[k + i]
    return total


def _strength(groups: DataFrame, prior: str) -> float:
    """Documents that the prior of a level weighs, by the method of moments.

    ``groups`` has a row per site: ``n`` documents, sum ``s`` of their probabilities, and the mean of the level
    above as ``prior``.  Sites that differ by no more than chance shrink fully, up to ``STRONGEST``.
    """
    gap = F.col("s") / F.col("n") - F.col(prior)
    row = groups.agg(
        F.sum(F.col("n") * gap * gap), F.sum(F.col("n")), F.sum(F.col("n") * F.col("n")), F.count("*"),
        F.sum(F.col("n") * F.col(prior) * (1 - F.col(prior))),
    ).first()
    spread, n, squares, n_sites, variance = (float(v or 0) for v in row)
    free = n - squares / n if n else 0.0
    if free <= 0 or variance <= 0:
        return STRONGEST
    within = variance / n
    between = (spread - (n_sites - 1) * within) / free
    return float(min(STRONGEST, max(1.0, within / between - 1))) if between > 0 else STRONGEST


def site_quality(
    docs: DataFrame, labels: DataFrame, sample: int = 20_000, host: str = "source", path: str = "lang",
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The ``carry`` columns of every row of ``docs(doc_id, text, host, path)`` as the struct ``row``, with
    ``doc_probability`` (classifier alone), ``host_posterior`` and ``path_posterior`` (without the document), and
    ``quality``, the probability of all together.

    ``labels(doc_id, quality)`` has 0 or 1; null labels are not used, without any the classifier says 0.5.  A null
    host or path is a site of its own.  Every row counts, repeated ones too.
    """
    texts = docs.select(
        whole_row(docs.select(*carry)).alias("row"), F.col("doc_id").cast("bigint").alias("doc"),
        F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), "text",
    )
    kinds = [("doc", T.LongType()), ("host", T.StringType()), ("path", T.StringType()), ("shape", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([texts.schema["row"], *[T.StructField(name, kind) for name, kind in kinds]])
    seen = stored(map_in_arrow(texts, _shapes, schema), "shapes")
    values, base = fit_weights(seen, labels, sample)
    judged = seen.select("row", "host", "path", _probability(_score(values)).alias("p"))

    paths = stored(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    n_all, s_all = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = (s_all / n_all) if n_all else 0.5
    host_strength = _strength(hosts.withColumn("prior", F.lit(float(mean))), "prior")
    above = hosts.select(F.col("host").alias("h"), F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    sites = paths.join(above, paths.host.eqNullSafe(above.h)).drop("h")
    host_mean = (F.lit(mean * host_strength) + F.col("host_s")) / (F.lit(host_strength) + F.col("host_n"))
    path_strength = _strength(sites.withColumn("prior", host_mean), "prior")

    sites = sites.withColumnsRenamed({"host": "site_host", "path": "site_path"})
    here = judged.host.eqNullSafe(sites.site_host) & judged.path.eqNullSafe(sites.site_path)
    p = F.col("p")
    host_posterior = (F.lit(mean * host_strength) + F.col("host_s") - p) / (F.lit(host_strength) + F.col("host_n") - 1)
    path_posterior = (F.col("host_posterior") * path_strength + F.col("s") - p) / (F.lit(path_strength) + F.col("n") - 1)
    evidence = _log_odds(p) - _log_odds(F.lit(base))
    return judged.join(sites, here).withColumn("host_posterior", host_posterior).withColumn(
        "path_posterior", path_posterior
    ).select(
        "row", p.alias("doc_probability"), "host_posterior", "path_posterior",
        _probability(_log_odds(F.col("path_posterior")) + evidence).alias("quality"),
    )
