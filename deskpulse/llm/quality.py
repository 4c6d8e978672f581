"""Quality classifier with hierarchical empirical Bayes (operator 8).

Method. Document evidence: boosted trees over whole-text features (symbol,
bar, capital and digit rates, word and line shapes, repetition), calibrated
by an isotonic curve, give each document a probability of being good. Site
evidence: over all documents, grouped sums of those probabilities per host and
per path of a host are shrunk: the global mean is the prior of a host, the
host's posterior mean is the prior of its paths. The strengths of the priors
are estimated from the spread of the group means (method of moments), so
sparse sites stay near their prior and only well-observed ones speak. A
document's posterior odds are its own odds times the odds ratio of its
path's posterior to the global mean; its own evidence is taken out of the sums
first, so that it does not count twice.

The host of a document is its ``source``; its path is the language section
``lang`` within the source. Fitting uses a bounded sample of labelled rows
(TRAIN_ROWS, by hash order); scoring and the site sums cover all documents.
Site sums are grouped with partial aggregation and joined back by the site's
key, so a host with a third of all rows costs one row per task.

Defined cases: null and empty texts are junk (score 0, not kept); a null host
or path is a site of its own; a document with several labels counts as good
only if all say so; without labels of both kinds every non-empty text has
probability 0.5 before site evidence and is kept; repeated rows each count;
an empty table gives no rows; ``keep_quality`` returns the columns it got.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.llm.boost import Boosted, Isotonic
from deskpulse.llm.io import cut, free_name, table, tidy
from deskpulse.llm.textfeatures import PLAIN, byte_counts, repeated_lines, runs_of
from deskpulse.llm.textvec import arrow_buffers, slices

TRAIN_ROWS = 20_000  # labelled documents that the model is fitted on, at most
KEEP = 0.5  # least posterior of a kept document
MOST_SHIFT = 3.0  # bound of the log odds that a site may add or take
FEATURES = ["symbols", "bars", "upper", "digits", "bangs", "word_len", "words", "distinct", "repeated", "line_words", "space", "punct"]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    h, first = PLAIN.tokens(data, offsets)
    c = byte_counts(data, offsets)
    words = np.diff(first).astype(float)
    chars, some = np.maximum(c["chars"], 1), np.maximum(words, 1)
    cols = [
        c["symbols"] / chars, c["bars"] / some, c["upper"] / np.maximum(c["letters"], 1), c["digits"] / chars, c["bangs"] / some,
        (c["letters"] + c["digits"]) / some, np.log1p(words), runs_of(h, first), repeated_lines(data, offsets), np.log1p(words / (c["lines"] + 1)),
        c["space"] / chars, (chars - c["letters"] - c["digits"] - c["space"]) / some,
    ]
    return np.stack(cols, 1)


def fit_quality(docs: DataFrame, labels: DataFrame) -> dict:
    """Trees and calibration, fitted on a bounded sample (small)."""
    y = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    train = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(y), "doc_id")  # rows are bounded, so the broadcast is

    def run(batches):
        for whole in batches:
            for b in slices(whole, "text"):
                x = features(*arrow_buffers(b.column("text")))
                yield pa.record_batch([b.column("doc_id"), b.column("y"), *map(pa.array, x.T)], names=["doc_id", "y", *FEATURES])

    rows = train.mapInArrow(tidy(run), "doc_id long, y int, " + ", ".join(f"{f} double" for f in FEATURES))
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("y", *FEATURES)).alias("s")).select("doc_id", "s.*").toPandas()  # TRAIN_ROWS x features
    if rows.y.nunique() < 2:
        return {"trees": None}
    rows = rows.sort_values("doc_id")
    x, y = rows[FEATURES].to_numpy(), rows.y.to_numpy(float)
    cal = np.array([zlib.crc32(b"cal%d" % i) % 4 == 0 for i in rows.doc_id])
    if len(set(y[cal])) < 2 or len(set(y[~cal])) < 2:
        cal[:] = False
    trees = Boosted(rounds=60, depth=3, rate=0.15).fit(x[~cal], y[~cal])
    use = cal if cal.any() else ~cal
    return {"trees": trees, "curve": Isotonic(trees.raw(x[use]), y[use])}


def document_evidence(docs: DataFrame, model: dict, out: str, text: str = "text") -> DataFrame:
    """``docs`` plus the calibrated probability ``out`` of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the trees

    def score(x: np.ndarray, empty: np.ndarray) -> np.ndarray:
        m = shared.value
        p = m["curve"](m["trees"].raw(x)) if m["trees"] else np.full(len(x), 0.5)
        p[empty] = 0.0
        return p

    names = [f.name for f in docs.schema.fields]

    def run(batches):
        for whole in batches:
            for b in slices(whole, text):
                data, offsets = arrow_buffers(b.column(text))
                p = score(features(data, offsets), np.diff(offsets) == 0)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], names=[*names, out])

    return docs.mapInArrow(tidy(run), _with_field(docs, out))


def _with_field(docs: DataFrame, name: str):
    from pyspark.sql.types import DoubleType, StructField, StructType

    return StructType([*docs.schema.fields, StructField(name, DoubleType())])


def _prior_strength(groups: DataFrame, mean: str, n: str, centre: str) -> float:
    """Weight, in documents, of a group's prior: the method-of-moments estimate
    of a beta prior from the spread of the group means about their centres."""
    within = F.col(centre) * (1 - F.col(centre))
    r = groups.where(F.col(n) > 1).agg(F.sum(F.col(n) * F.pow(F.col(mean) - F.col(centre), F.lit(2))).alias("s"), F.sum(within).alias("w"), F.sum(F.col(n) * within).alias("nw"), F.count("*").alias("k")).first()
    if not r["k"] or not r["nw"]:
        return 1000.0
    # E[n (mean - centre)^2] = within * (1 + (n - 1) * rho); rho = 1 / (strength + 1)
    rho = (r["s"] - r["w"]) / max(r["nw"] - r["w"], 1e-9)
    return float(min(max(1 / max(rho, 1e-4) - 1, 1.0), 1000.0))


def posterior(scored: DataFrame, p: str, out: str, host: str = "source", path: str = "lang") -> DataFrame:
    """``scored`` plus the posterior ``out`` that combines ``p`` with the sites'."""
    h, q = free_name(scored, "host_key"), free_name(scored, "path_key")
    keyed = scored.withColumn(h, F.coalesce(F.concat(F.lit("+"), F.col(host)), F.lit("-"))).withColumn(q, F.coalesce(F.concat(F.lit("+"), F.col(path)), F.lit("-")))
    paths = cut(keyed.groupBy(h, q).agg(F.sum(p).alias("ps"), F.count("*").alias("pn")))
    hosts = paths.groupBy(h).agg(F.sum("ps").alias("hs"), F.sum("pn").alias("hn"))
    total = hosts.agg(F.sum("hs"), F.sum("hn")).first()
    mean = min(max((total[0] or 0.0) / max(total[1] or 1, 1), 1e-3), 1 - 1e-3)
    a = _prior_strength(hosts.select((F.col("hs") / F.col("hn")).alias("m"), F.col("hn").alias("n"), F.lit(mean).alias("c")), "m", "n", "c")
    sites = paths.join(hosts, h)
    centre = (F.lit(a * mean) + F.col("hs")) / (a + F.col("hn"))
    b = _prior_strength(sites.select((F.col("ps") / F.col("pn")).alias("m"), F.col("pn").alias("n"), centre.alias("c")), "m", "n", "c")
    sums = [free_name(scored, f"site_{c}") for c in ("ps", "pn", "hs", "hn")]
    sites = sites.select(h, q, *[F.col(c).alias(s) for c, s in zip(("ps", "pn", "hs", "hn"), sums, strict=True)])
    joined = keyed.join(sites, [h, q])
    ps, pn, hs, hn = (F.col(s) for s in sums)
    own = F.col(p)
    host_mean = (F.lit(a * mean) + hs - own) / (a + hn - 1)
    path_mean = F.greatest(F.least((b * host_mean + ps - own) / (b + pn - 1), F.lit(1 - 1e-3)), F.lit(1e-3))
    logit = lambda x: F.log(x / (1 - x))
    shift = F.greatest(F.least(logit(path_mean) - logit(F.lit(mean)), F.lit(MOST_SHIFT)), F.lit(-MOST_SHIFT))
    safe = F.greatest(F.least(own, F.lit(1 - 1e-6)), F.lit(1e-6))
    value = F.when(own <= 0, 0.0).otherwise(1 / (1 + F.exp(-(logit(safe) + shift))))
    return joined.withColumn(out, value).select(*scored.columns, out)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang, source, document_score, posterior, keep) for every row."""
    narrow = docs.select("doc_id", "lang", "source", "text")
    scored = cut(document_evidence(narrow, fit_quality(docs, labels), "document_score").drop("text"))
    return posterior(scored, "document_score", "posterior").withColumn("keep", F.col("posterior") >= KEEP)


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with the same columns.

    Rows are told apart by a hash of their id, text and site, so one narrow row of each is scored, cut and joined
    with its site; texts are read again only to leave out the rejected rows and never shuffled with them.
    """
    row, post = free_name(docs, "row_key"), free_name(docs, "posterior")
    key = F.struct("doc_id", F.xxhash64("doc_id", "text", "lang", "source"), F.hash("text", "source", "lang", "doc_id"))
    keyed = docs.withColumn(row, key)
    narrow = keyed.select(row, "lang", "source", "text")
    scored = cut(document_evidence(narrow, fit_quality(docs, labels), "document_score").drop("text"))
    rejected = cut(posterior(scored, "document_score", post).where(F.col(post) < KEEP).select(F.col(row).alias("rejected_row")).distinct())
    return keyed.join(rejected, F.col(row).eqNullSafe(F.col("rejected_row")), "left_anti").select(*docs.columns)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    """The classifier over all documents."""
    out = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "document_score", "posterior", "keep")
