"""Near-duplicate documents by BagMinHash over word shingles.

A document is the bag of its five-word shingles. BagMinHash gives each shingle a
Poisson process over its weight axis: points have a time, a place on the axis and
a signature component, and a document sees the points below its count. The axis is
cut into [0,1), [1,2), [2,4), [4,8), ... with one process each, so a weight takes a
logarithmic number of processes and, within the last one, places decide. The
earliest visible point of each component makes the signature: two documents agree
in a component with the probability of their weighted Jaccard similarity. Only
points before a time limit are drawn, which falls with the document's weight, so the
work is one draw a shingle plus the points that the components need.

Signatures are banded. Equal bags are one class from the start. Buckets of the
bands never emit all their pairs: in each round a member is compared to one member
of its bucket, first the smallest id, then another picked by hash, and every
comparison is an exact multiset overlap of the texts. Bands are taken in groups: links
found in one group spare a member all buckets of the next whose smallest id is already
in its component, and it meets each other component once. Members of one bucket that
are connected by then need no more comparisons. Those still apart are compared with
all members of other components of their bucket that could be similar enough, so no
link is lost; in large buckets these are the ones that share a shingle among the
rarest of both, which rules out much edited copies in a large group of copies.

Result: one row for each input row with the smallest id of its class.

Defined results: words are runs of anything but 0x20 and 0x09-0x0D and keep their
case; a text of one to four words has a single shingle; a text without words (or
null) is linked to nothing and is its own class; a repeated row gets its class in
each copy; texts under one id are documents of their own, each with its own class; a row
without id gets the class of its equals, or null if no row of its class has an id.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldo.functions.ranking import number_rows
from saldo.llm.components import components, stored
from saldo.llm.textarrays import Words, chunks, mix, shingles
from saldo.session import ensure_checkpoint_dir, work_path

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 25, 5
COMPONENTS = BANDS * ROWS
#: Pairs whose signatures agree less are not compared in full; at a similarity of
#: 0.8 the chance of that is about one in 20,000, as that of sharing no band.
LEAST_ESTIMATE, SPREAD_ROUNDS = 0.66, 1
#: Bands are compared in groups; links of one group spare the comparisons of the next.
BAND_GROUPS = (0, 3, 10, BANDS)
CHUNK = 1_000_000
#: Members of a bucket that are compared directly; larger buckets meet over rare shingles.
SMALL_BUCKET = 64
#: Holders that may count as few, in the order in which they are tried; shingles of more that are sent to the tasks.
FEW_HOLDERS, MOST_FREQUENT, RANGE_KEYS = (1, 4, 16, 64, 256), 500_000, 1_000_000
_STEP, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _times(n: int, by: np.uint64) -> np.uint64:
    return np.uint64(n * int(by) % 2**64)


def bags(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts with their counts and the text that each belongs to."""
    words = Words(texts)
    found = [np.sort(shingles(words.hashes[a:b], size)) for a, b in zip(words.first[:-1], words.first[1:])]
    doc = np.repeat(np.arange(len(texts)), [len(f) for f in found])
    keys = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
    begin = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.append(begin, len(keys)))
    return keys[begin], counts, doc[begin]


def signatures(keys: np.ndarray, counts: np.ndarray, doc: np.ndarray, n_docs: int, m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash signatures, one row of ``m`` times a text; rows of texts without shingles stay infinite."""
    best = np.full(n_docs * m, np.inf)
    total = np.bincount(doc, weights=counts, minlength=n_docs)
    # one process for each shingle and part of the weight axis that its count reaches
    parts = [(keys, counts, doc, 0, 1)]
    start, length = 1, 1
    while (reach := counts > start).any():
        parts.append((keys[reach], counts[reach], doc[reach], start, length))
        start, length = start + length, 2 * length
    key = np.concatenate([mix(k + _times(s, _OTHER)) for k, _, _, s, _ in parts])
    count = np.concatenate([c for _, c, _, _, _ in parts])
    owner = np.concatenate([d for _, _, d, _, _ in parts])
    begin = np.concatenate([np.full(len(k), s) for k, _, _, s, _ in parts])
    rate = np.concatenate([np.full(len(k), n) for k, _, _, _, n in parts]).astype(float)
    pending = total > 0
    factor = np.log(m) + 4
    while pending.any():
        limit = factor * m / np.maximum(total, 1)
        alive = np.flatnonzero(pending[owner])
        time, drawn = np.zeros(len(alive)), 0
        while len(alive):
            drawn += 1
            x = mix(key[alive] + _times(drawn, _STEP))
            time = time - np.log(((x >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / rate[alive]
            ahead = time <= limit[owner[alive]]
            alive, time, x = alive[ahead], time[ahead], x[ahead]
            y = mix(x ^ _OTHER)
            place = begin[alive] + (y & np.uint64(0xFFFFFFFF)) * (rate[alive] * 2.0**-32)
            seen = place < count[alive]
            at = owner[alive] * m + ((y >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
            np.minimum.at(best, at[seen], time[seen])
        grid = best.reshape(n_docs, m)
        pending = pending & np.isinf(grid).any(axis=1)
        factor *= 2
    return best.reshape(n_docs, m)


def overlap(one: str, two: str, size: int = SHINGLE) -> float:
    """Exact weighted Jaccard similarity of two texts' shingle bags."""
    keys, counts, doc = bags([one, two], size)
    first, second = doc == 0, doc == 1
    _, a, b = np.intersect1d(keys[first], keys[second], assume_unique=True, return_indices=True)
    shared = np.minimum(counts[first][a], counts[second][b]).sum()
    every = counts.sum() - shared
    return float(shared / every) if every else 0.0


def sketch(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, h, k1, k2, n, bands, sig) of every row: hash of the text, two hashes and the size of its bag, band keys, signature."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for a, b in chunks(texts, CHUNK):
                keys, counts, doc = bags(texts[a:b])
                n_docs = b - a
                times = signatures(keys, counts, doc, n_docs)
                sums = [np.zeros(n_docs, dtype=np.uint64) for _ in range(2)]
                for total, salt in zip(sums, (_STEP, _OTHER)):
                    np.add.at(total, doc, mix(mix(keys ^ salt) + counts.astype(np.uint64)))
                size = np.bincount(doc, weights=counts, minlength=n_docs).astype(np.int64)
                value = mix(np.ascontiguousarray(times).view(np.uint64).reshape(n_docs, COMPONENTS))
                band = np.zeros((n_docs, BANDS), dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
                for r in range(ROWS):
                    band = mix(band * _STEP + value[:, r::ROWS])
                short = (value >> np.uint64(48)).astype(np.uint16)
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"].iloc[a:b],
                        "h": batch["h"].iloc[a:b],
                        "k1": sums[0].view(np.int64),
                        "k2": sums[1].view(np.int64),
                        "n": size,
                        "bands": [list(x) if s else None for x, s in zip(band.view(np.int64), size)],
                        "sig": [x.tobytes() if s else None for x, s in zip(short, size)],
                    }
                )

    kind = dict(docs.dtypes)[doc_id]
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    return narrow.mapInPandas(run, f"doc_id {kind}, h long, k1 long, k2 long, n long, bands array<long>, sig binary")


def compare(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts (id, text) are similar enough, by exact overlap."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [overlap(one, two) for one, two in zip(batch["one"], batch["two"])]
            keep = np.array(values) >= similarity - 1e-12
            yield batch.loc[keep, ["a", "b"]]

    one = texts.select(F.col("id").alias("a"), F.col("text").alias("one"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("two"))
    kind = dict(pairs.dtypes)["a"]
    return pairs.join(two, "b").join(one, "a").select("a", "b", "one", "two").mapInPandas(run, f"a {kind}, b {kind}")


def joined_labels(labels: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """(node, label) after the links ``fresh`` (a, b) were added; only components that they touch are worked on."""
    if labels is None:
        return components(fresh)
    ends = fresh.select(F.col("a").alias("node")).union(fresh.select("b")).distinct()
    known = stored(labels.unionByName(ends.join(labels, "node", "left_anti").withColumn("label", F.col("node"))))
    one = known.select(F.col("node").alias("a"), F.col("label").alias("la"))
    two = known.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    between = fresh.join(one, "a").join(two, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    moved = components(between).select(F.col("node").alias("label"), F.col("label").alias("to"))
    return stored(known.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")))


def _star(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Pairs (a, b) of members and the smallest ids of their buckets, one for each component that a member is not in."""
    away = members.filter(F.col("id") != F.col("low"))
    if labels is None:
        return away.select(F.col("id").alias("a"), F.col("low").alias("b")).distinct()
    mine = labels.select(F.col("node").alias("id"), F.col("label").alias("mine"))
    theirs = labels.select(F.col("node").alias("low"), F.col("label").alias("theirs"))
    seen = away.select("id", "low").distinct().join(mine, "id", "left").join(theirs, "low", "left")
    other = F.coalesce("theirs", "low")
    apart = seen.filter(F.coalesce("mine", "id") != other)
    return apart.groupBy(F.col("id").alias("a"), other.alias("_other")).agg(F.min("low").alias("b")).select("a", "b")


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, h, class_id, kept) for every row of ``docs``, h the hash of its text.

    ``kept`` marks the rows that stand for their class: those with its smallest id and, of
    several texts under that id, with one of them. Bags are numbered in the order of their
    ids and linked by number, so two texts under one id are two documents.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    sketches = sketch(docs, doc_id, text).checkpoint()
    bag = ["k1", "k2", "n"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("first")
    equal = sketches.filter("n > 0").groupBy(*bag).agg(first)
    equal = number_rows(equal, "id", F.asc("first"), F.asc("k1"), F.asc("k2"))
    equal = stored(equal.select("id", *bag, F.col("first.doc_id").alias("rep"), F.col("first.h").alias("rep_h")))
    stands = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("h") == F.col("rep_h"))
    reps = sketches.join(equal, bag).filter(stands).dropDuplicates(["id"])
    reps = stored(reps.select("id", "n", "bands", "sig"))
    rows = reps.select("id", F.posexplode("bands").alias("band", "bucket"))
    crowds = rows.groupBy("bucket").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    members = stored(rows.join(crowds.select("bucket", "low"), "bucket"))
    needed = equal.join(members.select("id").distinct(), "id", "left_semi").select("id", "rep", "rep_h")
    place = work_path(spark, "neardup-texts")
    source = docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("rep_h"), F.col(text).alias("text"))
    found = source.join(needed, "rep_h").filter(F.col("_doc").eqNullSafe(F.col("rep"))).select("id", "text")
    found.dropDuplicates(["id"]).write.parquet(place)
    texts = spark.read.parquet(place)

    labels = None
    for begin, end in itertools.pairwise(BAND_GROUPS):
        part = members.filter((F.col("band") >= begin) & (F.col("band") < end))
        fresh = stored(compare(_star(part, labels), texts, similarity))
        if not fresh.isEmpty():
            labels = joined_labels(labels, fresh)
    if labels is None:
        labels = members.select(F.col("id").alias("node"), F.col("id").alias("label")).limit(0)
    for turn in range(SPREAD_ROUNDS + 1):
        apart = stored(_apart(members, labels))
        if apart.isEmpty():
            break
        if turn < SPREAD_ROUNDS:
            draw = F.min(F.struct(F.xxhash64("id", "bucket", F.lit(turn)).alias("h"), "id", "label")).alias("pick")
            picked = apart.groupBy("bucket").agg(draw).select("bucket", F.col("pick.id").alias("b"), F.col("pick.label").alias("other"))
            wanted = apart.join(picked, "bucket").filter(F.col("label") != F.col("other"))
            wanted = wanted.groupBy(F.col("id").alias("a"), "other").agg(F.min("b").alias("b")).select("a", "b")
        else:
            cross = _open_pairs(apart, texts, reps, similarity)
            wanted = _likely(cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), reps)
        fresh = stored(compare(wanted.distinct(), texts, similarity))
        if not fresh.isEmpty():
            labels = joined_labels(labels, fresh)
    named = equal.join(labels, equal["id"] == labels["node"], "left").select(*bag, "rep", "rep_h", F.coalesce("label", "id").alias("label"))
    heads = equal.select(F.col("id").alias("label"), F.col("rep").alias("class_id"), F.col("rep_h").alias("class_h"))
    each = named.join(heads, "label").select(*bag, "class_id", "class_h")
    joined = sketches.select("doc_id", "h", *bag).join(each, bag, "left")
    heads_it = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("h") == F.col("class_h"))
    empty = F.col("n") == 0
    return joined.select(
        "doc_id", "h", F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (empty | heads_it).alias("kept"),
    )


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) for every row of ``docs``."""
    return grouped(docs, doc_id, text, similarity).select("doc_id", "class_id")


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, id, label) of the buckets whose members belong to several components."""
    known = members.join(labels, members["id"] == labels["node"], "left").select("bucket", "id", F.coalesce("label", "id").alias("label"))
    mixed = known.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("bucket")
    return known.join(mixed, "bucket")


def _open_pairs(apart: DataFrame, texts: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) of different components of a bucket that could be similar enough.

    Members of a small bucket meet directly. In a large one two documents meet only
    over a shared shingle among the rarest of both: if their similarity suffices,
    the weight that a document does not share is at most (1 - similarity) of its size,
    so the rarest shingle that they share lies within that weight of either's rarest;
    what comes before it is not shared, which bounds the overlap once more.
    """
    sized = apart.join(reps.select("id", "n"), "id")
    crowd = apart.groupBy("bucket").agg(F.min("label").alias("main"), F.count(F.lit(1)).alias("k"))
    known = stored(sized.join(crowd, "bucket"))
    wide = known.filter(F.col("k") > SMALL_BUCKET).groupBy("id", "label", "n").agg(F.max(F.col("label") != F.col("main")).alias("few"))

    def meet(all_: DataFrame, key: str) -> DataFrame:
        """Pairs of a row outside the main component with any other; two such rows make one pair."""
        theirs = all_.select(
            F.col(key).alias("key2"), F.col("id").alias("b"), F.col("label").alias("label2"),
            F.col("n").alias("n2"), F.col("before").alias("before2"), F.col("few").alias("few2"),
        )
        shared = F.least(F.col("n") - F.col("before"), F.col("n2") - F.col("before2"))
        near = shared >= (F.col("n") + F.col("n2") - shared) * similarity - 1e-6
        once = ~F.col("few2") | (F.col("id") < F.col("b"))
        on = (F.col(key) == F.col("key2")) & (F.col("label") != F.col("label2")) & near & once
        return all_.filter("few").join(theirs, on).select(F.col("id").alias("a"), "b")

    small = known.filter(F.col("k") <= SMALL_BUCKET)
    small = small.withColumn("before", F.lit(0)).withColumn("few", F.col("label") != F.col("main"))
    direct = meet(small, "bucket")

    # spread by number: shingles of a few long texts must not meet in one task
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    front = stored(_fronts(texts.join(wide, "id").repartition(parts, "id"), similarity))
    return direct.unionByName(meet(front, "key")).distinct()


def _shingle_rows(source: DataFrame) -> DataFrame:
    """(id, key, c): the distinct shingles of each text with their counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in chunks(batch["text"].tolist(), CHUNK):
                keys, counts, doc = bags(batch["text"].iloc[a:b].tolist())
                yield pd.DataFrame({"id": batch["id"].iloc[a:b].to_numpy()[doc], "key": keys.view(np.int64), "c": counts})

    return source.mapInPandas(run, f"id {dict(source.dtypes)['id']}, key long, c long")


def _holders(source: DataFrame) -> DataFrame:
    """(key, df): how many texts hold each shingle that several hold.

    Each batch adds up its own shingles and gives a row for each hash range, not for each
    shingle; a range has at most about ``RANGE_KEYS`` of them.
    """
    spark = source.sparkSession
    total = source.agg(F.sum("n").alias("n")).first()["n"] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_KEYS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in chunks(batch["text"].tolist(), CHUNK):
                keys, times = np.unique(bags(batch["text"].iloc[a:b].tolist())[0], return_counts=True)
                place = (keys % np.uint64(ranges)).astype(np.int64)
                order = np.argsort(place, kind="stable")
                keys, times, place = keys[order], times[order].astype(np.int64), place[order]
                cuts = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else []
                ends = [*cuts[1:], len(place)]
                packed = [(int(place[x]), keys[x:y].tobytes(), times[x:y].tobytes()) for x, y in zip(cuts, ends)]
                yield pd.DataFrame(packed, columns=["part", "keys", "times"])

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(rows["keys"]), dtype=np.int64)
        times = np.frombuffer(b"".join(rows["times"]), dtype=np.int64)
        known, at = np.unique(keys, return_inverse=True)
        df = np.bincount(at, weights=times).astype(np.int64)
        return pd.DataFrame({"key": known[df > 1], "df": df[df > 1]})

    packed = source.select("text").mapInPandas(run, "part long, keys binary, times binary")
    return packed.groupBy("part").applyInPandas(added, "key long, df long")


def _fronts(source: DataFrame, similarity: float) -> DataFrame:
    """(id, label, n, few, key, before): each text's rarest shingles, as far as a similar text may lack them.

    ``before`` is the weight of the shingles before one. Any one order of all shingles would
    do: those of few holders come first, in the order of their hashes, then the others by their
    number of holders. The others are sent to the tasks, which then give only the fronts; few
    are as many holders as make at most ``MOST_FREQUENT`` others. If one holder is few, a
    shingle that is none of the others meets nobody and is left out. Where there are always too
    many others, all shingles are joined with their numbers of holders instead.
    """
    holders = stored(_holders(source))
    sizes = holders.agg(*[F.sum((F.col("df") > k).cast("long")).alias(str(k)) for k in FEW_HOLDERS]).first()
    few = next((k for k in FEW_HOLDERS if (sizes[str(k)] or 0) <= MOST_FREQUENT), None)
    if few is None:
        rows = _shingle_rows(source).join(holders, "key", "left").withColumn("df", F.coalesce("df", F.lit(1)))
        rarest = Window.partitionBy("id").orderBy("df", "key").rowsBetween(Window.unboundedPreceding, -1)
        placed = rows.withColumn("before", F.coalesce(F.sum("c").over(rarest), F.lit(0))).select("id", "key", "before")
        told = placed.join(source.drop("text"), "id")
        return told.filter(F.col("before") <= F.col("n") * (1 - similarity) + 1e-6)
    table = holders.filter(F.col("df") > few).toArrow()
    known, df = (table.column(c).to_numpy() for c in ("key", "df"))
    order = np.argsort(known)
    shared = source.sparkSession.sparkContext.broadcast((known[order], df[order]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, df = shared.value
        for batch in batches:
            for a, b in chunks(batch["text"].tolist(), CHUNK):
                keys, counts, doc = bags(batch["text"].iloc[a:b].tolist())
                key = keys.view(np.int64)
                often = np.zeros(len(key), dtype=np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                    often = np.where(known[at] == key, df[at], 0)
                rank = np.lexsort((key, often, doc))
                key, weight, doc, often = key[rank], counts[rank], doc[rank], often[rank]
                sums = np.cumsum(weight) - weight
                first = np.searchsorted(doc, np.arange(b - a))
                total = np.bincount(doc, weights=weight, minlength=b - a)
                before = sums - sums[np.minimum(first, len(sums) - 1)][doc]
                keep = before <= total[doc] * (1 - similarity) + 1e-6
                if few == 1:
                    keep &= often > 0
                own = {c: batch[c].iloc[a:b].to_numpy()[doc[keep]] for c in ("id", "label", "n", "few")}
                yield pd.DataFrame(own | {"key": key[keep], "before": before[keep]})

    return source.mapInPandas(run, "id long, label long, n long, few boolean, key long, before long")


def _likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in ``LEAST_ESTIMATE`` of the components or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                one, two = (np.frombuffer(b"".join(batch[c]), dtype=np.uint16).reshape(len(batch), -1) for c in ("one", "two"))
                yield batch.loc[(one == two).mean(axis=1) >= LEAST_ESTIMATE, ["a", "b"]]

    kind = dict(pairs.dtypes)["a"]
    one = reps.select(F.col("id").alias("a"), F.col("sig").alias("one"))
    two = reps.select(F.col("id").alias("b"), F.col("sig").alias("two"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInPandas(run, f"a {kind}, b {kind}")
