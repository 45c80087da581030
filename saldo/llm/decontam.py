"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit distance.

Word by word, the CGK walk writes the current word and moves on or stays, as a
random bit of (step, word) says. Two sequences with few edits walk apart and meet
again, so edit distance becomes Hamming distance between the walks. A sample of
steps, hashed, is equal for two windows with the chance that all its steps agree;
``SEEDS`` walks with ``SAMPLES`` samples each bring the recall to the target.

Windows have the size of the items: sizes form a ladder, and an item is indexed
with the largest rung that fits, at the first ``STRIDE`` offsets; so text windows
need to start at every ``STRIDE``-th word only. Long items are indexed every half
window. One walk serves all rungs, as a shorter window's walk is a prefix of it.

A candidate is confirmed by the exact edit distance between the whole item and the
best passage around the window, in characters of the lower-cased words joined by
single blanks; it may be ``MAX_EDITS`` of the item's length.

Items of fewer than ``SHORT`` words are too small for that, and a text without blanks
is one word whatever its length. They are found by characters instead: with at most e
edits at least one of e + 1 pieces of the item is in the text unchanged, so the exact
distance is computed around each place of a piece, and none is missed. A word border at
the item's ends counts as a character there (not next to a script without blanks), so
that a short word is not found inside longer ones; an item between characters that are
neither letters nor digits has distance 0. This takes a search of each text for each
piece, which grows with the number of short items.

The items go to the tasks in blocks of at most ``BLOCK_BYTES`` of text, one pass
over the documents for each block, so what is broadcast has a bound for any
benchmark: about ten times that. Documents are never shuffled; only matches are.

Defined results: one row for each (document, item) that match, with the smallest
distance; null texts and texts without words match nothing, nor do items without
words; repeated items with one id count as one, and of several texts under one id the
nearest counts; documents without id are one, of which the nearest counts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.shared import held, share
from saldo.llm.textarrays import BASE, Words, chunks, mix

STRIDE, SEEDS, SAMPLES, POSITIONS = 4, 6, 5, 5
SHORT = 2 * STRIDE
LADDER = [1, 2, 3, 4, 6, 9, 13, 19, 28, 42, 64]
MAX_EDITS, BLOCK_BYTES, CHUNK = 0.2, 8 * 1024 * 1024, 1_000_000


def steps_of(rung: int) -> int:
    """Steps of a walk over a window of ``rung`` words: about three quarters of it, so that it ends inside."""
    return max(1, rung * 3 // 2)


def sampled_steps(seed: int, rung: int) -> list[list[int]]:
    """The steps that each sample of a walk looks at."""
    draw = np.random.default_rng([seed, rung])
    n = steps_of(rung)
    return [sorted(draw.choice(n, size=min(POSITIONS, n), replace=False).tolist()) for _ in range(SAMPLES)]


def walk_keys(hashes: np.ndarray, starts: np.ndarray, seed: int, rungs: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(rung, sample, key of each start) for walks over ``hashes``, which is padded beyond the last start."""
    plans = [(rung, q, set(steps)) for rung in rungs for q, steps in enumerate(sampled_steps(seed, rung))]
    keys = {(rung, q): np.zeros(len(starts), dtype=np.uint64) for rung, q, _ in plans}
    at = starts.copy()
    last = max((steps_of(r) for r in rungs), default=0)
    salt, mixed = 0, None
    for step in range(last):
        if step % 64 == 0:
            salt += 1
            mixed = mix(hashes ^ np.uint64((seed * 1000 + salt) * int(BASE) % 2**64))
        here = mixed[at]
        for rung, q, steps in plans:
            if step in steps:
                keys[rung, q] *= BASE
                keys[rung, q] += here
        at += ((here >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)
    for (rung, q), key in keys.items():
        yield rung, q, key


def best_distance(item: str, passage: str) -> int:
    """Smallest edit distance between the item and any part of the passage (bit-parallel columns)."""
    n = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    full, high = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best = score
    for c in passage:
        match = masks.get(c, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        best = min(best, score)
    return best


def word_list(text: str) -> list[str]:
    """Lower-cased words, cut at 0x20 and 0x09-0x0D."""
    return [w.decode("utf-8", "surrogatepass") for w in text.lower().encode("utf-8", "surrogatepass").split()]


#: Scripts that are written without blanks between words: Thai to Myanmar, Khmer, kana, Han.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_SPACED = rf"[^\W_{_UNSPACED}]"


class ShortItem:
    """An item of few words, found by characters in texts whose words are joined by single blanks."""

    def __init__(self, text: str, max_edits: float):
        self.length = len(text)
        left, right = (re.match(_SPACED, c) is not None for c in (text[0], text[-1]))
        self.exact = re.compile((rf"(?<!{_SPACED})" if left else "") + re.escape(text) + (rf"(?!{_SPACED})" if right else ""))
        self.padded = " " * left + text + " " * right
        self.limit = int(max_edits * self.length)
        n = min(self.limit + 1, len(self.padded))
        cuts = [len(self.padded) * k // n for k in range(n + 1)]
        self.pieces = [(self.padded[a:b], a) for a, b in zip(cuts, cuts[1:])]

    def distance(self, text: str) -> int | None:
        """Smallest distance in a text with a blank before and after; None beyond the limit."""
        if self.exact.search(text):
            return 0
        spans = []
        for piece, offset in self.pieces if self.limit else []:
            at = text.find(piece)
            while at >= 0:
                begin = at - offset - self.limit
                spans.append((max(0, begin), begin + len(self.padded) + 2 * self.limit))
                at = text.find(piece, at + 1)
        best, end = self.limit + 1, 0
        merged: list[list[int]] = []
        for a, b in sorted(spans):
            if merged and a <= end:
                merged[-1][1] = end = max(end, b)
            else:
                merged.append([a, b])
                end = b
        for a, b in merged:
            best = min(best, best_distance(self.padded, text[a:b]))
        return best if best <= self.limit else None


class ItemIndex:
    """LSH tables of one block of items: for each walk, rung and sample the keys of all indexed windows.

    A table has two bytes of presence bits, half a key and a number for each window, in all
    about ten bytes for each byte of the items; the windows' items and offsets are kept once.
    """

    def __init__(self, items: Iterable[tuple[object, str]]):
        pairs = list(items)
        self.ids = [i for i, _ in pairs]
        self.words = [word_list(text) for _, text in pairs]
        self.text = [" ".join(w) for w in self.words]
        found = Words([" ".join(w) for w in self.words])
        place = []  # (rung, start in hashes, item, offset)
        self.short = [k for k, words in enumerate(self.words) if 0 < len(words) < SHORT]
        for k, words in enumerate(self.words):
            if len(words) < SHORT:
                continue
            room = len(words) - STRIDE + 1
            rung = max((r for r in LADDER if r <= room), default=1)
            for anchor in range(0, max(1, len(words) - rung - STRIDE + 2), max(STRIDE, rung // 2)):
                for offset in range(anchor, min(anchor + STRIDE, len(words))):
                    place.append((rung, int(found.first[k]) + offset, k, offset))
        self.rungs = sorted({p[0] for p in place})
        hashes = np.append(found.hashes, np.zeros(2 * max(LADDER), dtype=np.uint64))
        self.tables, self.windows = {}, {}
        for rung in self.rungs:
            chosen = [p for p in place if p[0] == rung]
            starts = np.array([p[1] for p in chosen], dtype=np.int64)
            self.windows[rung] = np.array([p[2:] for p in chosen], dtype=np.int32)  # item, offset in it
            bits = max(10, math.ceil(math.log2(16 * len(chosen))))
            for seed in range(SEEDS):
                for r, q, key in walk_keys(hashes, starts, seed, [rung]):
                    order = np.argsort(key, kind="stable").astype(np.int32)
                    high = (key >> np.uint64(64 - bits)).astype(np.int64)
                    present = np.zeros(1 << (bits - 3), dtype=np.uint8)
                    np.bitwise_or.at(present, high >> 3, (1 << (high & 7)).astype(np.uint8))
                    self.tables[seed, r, q] = present, np.uint64(64 - bits), (key[order] >> np.uint64(32)).astype(np.uint32), order

    def nbytes(self) -> int:
        """Bytes of the tables."""
        arrays = [x for t in self.tables.values() for x in (t[0], t[2], t[3])] + list(self.windows.values())
        return sum(a.nbytes for a in arrays)

    def candidates(self, found: Words) -> np.ndarray:
        """Distinct (text, item, first word of the item in the text, counted in the batch), one a row."""
        sizes = np.diff(found.first)
        per = -(-sizes // STRIDE)
        doc = np.repeat(np.arange(len(sizes)), per)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        starts = found.first[doc] + within * STRIDE
        hashes = np.append(found.hashes, np.zeros(2 * max(LADDER), dtype=np.uint64))
        hits = []
        for seed in range(SEEDS):
            for rung, q, key in walk_keys(hashes, starts, seed, self.rungs):
                present, shift, known, order = self.tables[seed, rung, q]
                high = (key >> shift).astype(np.int64)
                maybe = np.flatnonzero((present[high >> 3] >> (high & 7).astype(np.uint8)) & 1)
                if len(maybe):
                    short = (key[maybe] >> np.uint64(32)).astype(np.uint32)
                    low = np.searchsorted(known, short, "left")
                    count = np.searchsorted(known, short, "right") - low
                    entry = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    at, window = np.repeat(maybe, count), self.windows[rung][order[entry]]
                    hits.append(np.stack((doc[at], window[:, 0], starts[at] - window[:, 1]), axis=1))
        return np.unique(np.concatenate(hits), axis=0) if hits else np.zeros((0, 3), dtype=np.int64)

    def matches(self, texts: list[str], max_edits: float) -> list[tuple[int, object, int]]:
        """(text number, item id, distance) of all confirmed candidates, the best of each pair."""
        found = Words([t.lower() for t in texts])
        best: dict[tuple[int, int], int] = {}
        seen: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for d, k, begin in self.candidates(found).tolist():
            n = len(self.words[k])
            slack = max(4, n // 4)
            a = max(int(found.first[d]), begin - slack)
            b = min(int(found.first[d + 1]), begin + n + slack)
            looked = seen.setdefault((d, k), [])
            if best.get((d, k)) == 0 or any(x <= a and b <= y for x, y in looked) or a >= b:
                continue
            # read on by a quarter, so that neighbouring candidates need no look of their own
            b = min(int(found.first[d + 1]), b + slack)
            looked.append((a, b))
            raw = found.data[found.starts[a] : found.ends[b - 1]].decode("utf-8", "surrogatepass")
            distance = best_distance(self.text[k], " ".join(word_list(raw)))
            if distance <= max_edits * len(self.text[k]):
                best[d, k] = min(distance, best.get((d, k), distance))
        if self.short:
            items = [(k, ShortItem(self.text[k], max_edits)) for k in self.short]
            for d, text in enumerate(texts):
                plain = f" {' '.join(word_list(text))} "
                for k, item in items:
                    distance = item.distance(plain)
                    if distance is not None:
                        best[d, k] = distance
        return [(d, self.ids[k], distance) for (d, k), distance in best.items()]


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of bounded size, by a hash."""
    size = items.agg(F.sum(F.octet_length("text") + 64).alias("b")).first()["b"] or 0
    n = -(-size // BLOCK_BYTES)
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r["item_id"], r["text"]) for r in part.collect() if r["text"].split()]


def matches(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", max_edits: float = MAX_EDITS,
) -> DataFrame:
    """(doc_id, item_id, distance) of every document and item that match."""
    spark = docs.sparkSession
    known = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).dropna().distinct()
    kinds = dict(docs.dtypes)[doc_id], dict(items.dtypes)[item_id]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int"
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = None
    for block in _blocks(known):
        shared = share(spark.sparkContext, ItemIndex(block))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                texts = [t if isinstance(t, str) else "" for t in batch["text"]]
                for a, b in chunks(texts, CHUNK):
                    hits = held(shared).matches(texts[a:b], max_edits)
                    if hits:
                        rows, ids, distances = zip(*hits)
                        yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b].iloc[list(rows)].to_numpy(), "item_id": list(ids), "distance": list(distances)})

        part = narrow.mapInPandas(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    return found.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))
