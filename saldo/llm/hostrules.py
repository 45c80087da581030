"""Quality rules by host: shrunk failure rates decide whole hosts.

Each text is measured once. Rule failures are summed by host, each rule's rate is
shrunk towards an empirical beta prior over all hosts (method of moments), and a
host whose shrunk rate for any rule exceeds ``MAX_RATE`` loses all its documents.
A host with few documents is drawn to the prior, so it takes evidence to drop one.

Measures come from words ``[^\\x20\\x09-\\x0D]+`` of the whole text.

Defined results: a null text has no words and fails the base rule; rows repeat as
often as in the input and count as often; documents without host are judged by
the base rule alone; with a single host, or hosts that all agree, the prior is
the overall rate with the weight of ``PRIOR_WEIGHT`` documents; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.session import ensure_checkpoint_dir

MAX_RATE, PRIOR_WEIGHT, BROADCAST_BYTES = 0.5, 10.0, 32 * 1024 * 1024
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def text_counts(text: str) -> tuple[int, ...]:
    """The numbers named in ``COUNTS``; bytes.split() cuts at exactly 0x20 and 0x09-0x0D."""
    words = text.encode("utf-8", "surrogatepass").split()
    gaps = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    repeated = 0
    if len(words) > 3:
        number: dict[bytes, int] = {}
        codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        pairs = np.unique(codes[:-1] * len(number) + codes[1:], return_inverse=True)[1]
        windows = pairs[:-1] * len(number) + codes[2:]
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        often = times[which] > 1
        covered = np.zeros(len(words), dtype=bool)
        for k in range(3):
            covered[k : k + len(often)] |= often
        repeated = int(covered.sum())
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), len(text) - gaps, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(doc_id, host, counts) of every row."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [text_counts(t if isinstance(t, str) else "") for t in batch["text"]]
            counts = np.array(found, dtype=np.int64).reshape(-1, len(COUNTS))
            out = {"doc_id": batch["doc_id"], "host": batch["host"]}
            yield pd.DataFrame(out | {name: counts[:, k] for k, name in enumerate(COUNTS)})

    kind = dict(docs.dtypes)[doc_id]
    schema = f"doc_id {kind}, host string, " + ", ".join(f"{c} long" for c in COUNTS)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).alias("text"))
    return narrow.mapInPandas(count, schema)


def rules() -> dict[str, Column]:
    """Rule name to whether a document fails it."""
    n = F.col("n_words")
    return {
        "base": (n < 50) | (100 * F.col("n_repeat_words") > 50 * n),
        "symbols": 10 * F.col("n_symbols") > n,
        "lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 10 * n),
    }


def host_verdicts(measured: DataFrame) -> DataFrame:
    """(host, n_docs, worst_rate, host_rejected): one row for each host.

    The prior of a rule has the mean and the variance of the hosts' rates, less
    the sampling variance that a host's own size explains.
    """
    failing = {r: F.sum(failed.cast("long")).alias(f"f_{r}") for r, failed in rules().items()}
    hosts = (
        measured.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n_docs"), *failing.values())
    )
    n = F.col("n_docs")
    moments = []
    for r in rules():
        rate = F.col(f"f_{r}") / n
        moments += [
            (F.sum(f"f_{r}") / F.sum(n)).alias(f"m_{r}"),
            F.var_pop(rate).alias(f"v_{r}"),
        ]
    prior = hosts.agg(F.avg(1 / n).alias("inverse_n"), *moments)
    shrunk = []
    for r in rules():
        mean = F.col(f"m_{r}")
        spread = mean * (1 - mean)
        between = F.col(f"v_{r}") - spread * F.col("inverse_n")
        weight = F.when((between > 0) & (spread > 0), F.greatest(spread / between - 1, F.lit(1.0))).otherwise(F.lit(PRIOR_WEIGHT))
        shrunk.append((F.col(f"f_{r}") + mean * weight) / (n + weight))
    # The prior is one row, so this join copies one row to each task.
    worst = hosts.join(F.broadcast(prior)).withColumn("worst_rate", F.greatest(*shrunk))
    return worst.select("host", "n_docs", "worst_rate", (F.col("worst_rate") > MAX_RATE).alias("host_rejected"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(doc_id, counts, base_failed, host_rate, kept) of every row of ``docs``.

    The narrow counts are checkpointed, so texts are read once.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    measured = measure(docs, doc_id, text, host).checkpoint()
    verdicts = host_verdicts(measured).select("host", "worst_rate", "host_rejected").checkpoint()
    # one row a host: broadcast where they are few, so that a hot host is no hot task
    size = verdicts.agg(F.sum(F.octet_length("host") + 64).alias("b")).first()["b"] or 0
    verdicts = F.broadcast(verdicts) if size <= BROADCAST_BYTES else verdicts
    failed = rules()["base"].alias("base_failed")
    joined = measured.join(verdicts, "host", "left").select("doc_id", *COUNTS, failed, "worst_rate", "host_rejected")
    kept = ~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))
    return joined.withColumn("kept", kept).withColumnRenamed("worst_rate", "host_rate").drop("host_rejected")
