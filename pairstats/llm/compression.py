"""Quality by compression with two dictionaries.

Zstandard dictionaries are trained on windows of a bounded sample of good and of bad labelled texts. A
text is compressed window by window with each: the difference of the two sizes over the larger one says
which kind it resembles. A logistic regression on further labelled texts, which no dictionary has
seen, turns the differences (of all windows together, of the worst ones, of the whole text) into a
calibrated score.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairstats.llm.common import bounded_sample, labelled, map_texts
from pairstats.llm.toxicity import fit
from pairstats.sinks.stage import materialize

#: Labelled texts of each kind for the dictionaries, and for calibration, at most.
SAMPLE, CALIBRATION = 3000, 12_000
#: Characters in a window; windows of each kind a dictionary is trained on; its bytes.
WINDOW, WINDOWS, DICTIONARY = 300, 12_000, 112_640
LEVEL = 1
FEATURES = 6


def cut(text: str, window: int = WINDOW) -> list[str]:
    """The whole text in windows; a short rest joins the last one."""
    n = max(1, round(len(text) / window))
    return [text[k * window : (k + 1) * window if k < n - 1 else None] for k in range(n)]


def _compressors(dictionaries: list[bytes]):
    import zstandard

    return [
        zstandard.ZstdCompressor(
            level=LEVEL,
            dict_data=zstandard.ZstdCompressionDict(d) if d else None,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        for d in dictionaries
    ]


def size_differences(texts: list[str], compressors: list) -> list[list[float]]:
    """FEATURES numbers for each text, from compressed sizes; an empty text has zeros."""
    bad, good = (c.compress for c in compressors)
    out = []
    for text in texts:
        if not text:
            out.append([0.0] * FEATURES)
            continue
        parts = [p.encode("utf-8", "surrogatepass") for p in cut(text)]
        a = np.array([len(bad(p)) for p in parts], float)
        b = np.array([len(good(p)) for p in parts], float)
        each = (a - b) / np.maximum(a, b)
        whole = "".join(text).encode("utf-8", "surrogatepass")
        x, y = len(bad(whole)), len(good(whole))
        out.append([
            float((a.sum() - b.sum()) / max(a.sum(), b.sum())),
            float(each.min()),
            float((each < 0).mean()),
            (x - y) / max(x, y),
            min(1.0, min(x, y) / len(whole)),
            math.log10(len(whole) + 1) / 5,
        ])
    return out


def train_dictionaries(texts: DataFrame) -> list[bytes]:
    """Of bad and of good texts (text, label): at most WINDOWS windows each, chosen by hash."""
    import zstandard

    windows = map_texts(texts, "windows array<string>", lambda t: [[cut(x) for x in t]])
    windows = windows.select("label", F.explode("windows").alias("window"))
    out = []
    for label in (0, 1):
        rows = (
            windows.where(F.col("label") == label)
            .orderBy(F.xxhash64("window"), "window")
            .limit(WINDOWS)
            .collect()
        )
        samples = [r["window"].encode("utf-8", "surrogatepass") for r in rows]
        samples = [s for s in samples if len(s) >= 8]
        size = min(DICTIONARY, sum(map(len, samples)) // 10)
        try:
            out.append(zstandard.train_dictionary(size, samples).as_bytes() if size > 256 else b"")
        except zstandard.ZstdError:  # too few or too uniform samples: the samples themselves
            out.append(b"".join(samples)[-DICTIONARY:])
    return out


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """``docs`` (doc_id, text and any columns but ``sizes``) without text, with ``score`` in [0, 1].

    ``learn`` says which labels may be learned from, by doc_id. Every row gets a score of its own,
    repeated rows and rows without id too; a null or empty text has no size and gets the score of
    that. Without labels of both kinds every score is their rate, or one half.
    """
    known = labelled(labels, "quality", learn)
    plain = docs.withColumn("text", F.coalesce("text", F.lit("")))
    first = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(6)), F.lit(2)) == 0
    # Bounded: 2 * SAMPLE and CALIBRATION ids.
    ids = bounded_sample(known.where(first & (F.col("label") == 0)), SAMPLE)
    ids = ids.union(bounded_sample(known.where(first & (F.col("label") == 1)), SAMPLE))
    ids = ids.select("doc_id", "label", F.lit(True).alias("first"))
    later = bounded_sample(known.where(~first), CALIBRATION)
    ids = ids.union(later.select("doc_id", "label", F.lit(False)))
    ids = materialize(ids, "quality_sample")
    texts = plain.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    texts = materialize(texts.select("text", "label", "first"), "quality_texts")
    rates = texts.groupBy("first").agg(F.avg("label").alias("p"), F.count_distinct("label").alias("n"))
    rates = {r["first"]: r for r in rates.collect()}
    if any(k not in rates or rates[k]["n"] < 2 for k in (True, False)):
        rate = float(next((r["p"] for r in rates.values()), 0.5))
        return plain.drop("text").withColumn("score", F.lit(rate))
    dictionaries = train_dictionaries(texts.where("first").select("text", "label"))

    def task():
        compressors = _compressors(dictionaries)
        return lambda texts: [size_differences(texts, compressors)]

    held = texts.where("NOT first").select("text", "label")
    rows = map_texts(held, "sizes array<double>", task, per_task=True).collect()
    weights = fit([r["sizes"] for r in rows], [r["label"] for r in rows], 0.1)
    sized = map_texts(plain, "sizes array<double>", task, per_task=True)
    total = F.lit(float(weights[-1]))
    for k in range(FEATURES):
        total = total + F.col("sizes")[k] * F.lit(float(weights[k]))
    return sized.withColumn("score", 1 / (1 + F.exp(-total))).drop("sizes")
