"""Toxicity by a subsequence-kernel support vector machine with Nystroem landmarks.

Strings are the words of sentences. The kernel of two words sums over all
subsequences of ``ORDER`` characters (word borders are characters too); one that
spans more than ``ORDER`` places loses the factor ``DECAY`` for each gap, up to
``SPAN`` places. So an insult with inserted characters still shares most of its
subsequences with the plain one, and endings it never had in training cost little.
Before that, anything but letters is taken out of words ("i.d.i.o.t"), and runs
of single letters are joined ("i d i o t").

Only documents have labels. Labelled sentences come from them: a sentence of a
clean document is clean; a toxic document's label goes to those of its sentences
that hold one of the fewest words which cover the toxic documents and are rare in
clean ones: a candidate occurs in no clean document, or its smoothed document rate in
toxic ones is ``LEAST_RATIO`` times that in clean ones, so that a few wrong labels or
quoting documents do not take an insult out of training. Words of toxic sentences that did the covering and words of clean
sentences train the machine in the space spanned by the landmarks. As the kernel
has explicit features, the trained machine is one weight for each subsequence of
the landmarks, and scoring a word does not depend on how many landmarks there are.

A document's score is a logistic function of its largest margins, of how many words lie
beyond the border and of how many it has, fitted to the labels of the sample.

Texts are not split into sentences: the machine is trained on and compares single words,
so toxicity carried by several ordinary words is not learned.

Learning takes about ``TRAIN_DOCS`` documents of each label, drawn by a hash of
their id; scores cover every whole text.

Defined results: a null or empty text, or one without letters, gets the score of
a text without any toxic word; rows repeat as often as in the input; a document
with several label rows is toxic if one of them says so; without both labels all
scores are 0.
"""

from __future__ import annotations

import heapq
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.shared import held, share
from saldo.llm.textarrays import BASE, chunks, code_points, mix
from saldo.session import ensure_checkpoint_dir

TRAIN_DOCS, MAX_CANDIDATES, MAX_CLEAN, LANDMARKS = 4000, 4000, 12_000, 256
ORDER, SPAN, DECAY, SYMBOLS, LONGEST, THRESHOLD = 4, 6, 0.5, 47, 40, 0.7
CHUNK = 1_000_000
SUMMARY = ["largest", "second", "beyond", "words"]
#: Smoothed document rate of a candidate in toxic documents over that in clean ones.
LEAST_RATIO = 4.0
#: Offsets of the places of a subsequence from its first one, and its weight.
SHAPES = [
    ((0, *rest), DECAY ** (rest[-1] + 1 - ORDER)) for rest in itertools.combinations(range(1, SPAN), ORDER - 1)
]


def fold_table() -> np.ndarray:
    """Code point to lower-case letter; 1 for white space, 0 for anything else."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
        elif char.isspace():
            table[point] = 1
    return table


class TextWords:
    """Distinct folded words of a batch and where they occur.

    ``letters`` with ``starts``/``ends`` are the distinct words, ``word`` numbers
    them in reading order and ``doc`` says whose each one is.
    """

    def __init__(self, texts: list[str], table: np.ndarray):
        points, offsets = code_points(texts)
        folded = table[points]
        doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
        used = folded != 0
        folded, doc = folded[used], doc[used]
        space = folded == 1
        edge = np.ones(len(folded) + 1, dtype=bool)
        edge[1:-1] = (space[1:] != space[:-1]) | (doc[1:] != doc[:-1])
        bounds = np.flatnonzero(edge)
        starts, ends = bounds[:-1], bounds[1:]
        real = ~space[starts] if len(starts) else np.zeros(0, dtype=bool)
        starts, ends = starts[real], ends[real]
        single = (ends - starts) == 1
        joins = np.zeros(len(starts), dtype=bool)
        if len(starts):
            joins[1:] = single[1:] & single[:-1] & (doc[starts[1:]] == doc[starts[:-1]])
        letters = folded[~space]
        sizes = ends - starts
        first = np.cumsum(sizes) - sizes
        starts = first[~joins]
        ends = np.append(starts[1:], len(letters)) if len(starts) else starts
        owner = doc[~space][starts] if len(starts) else np.zeros(0, dtype=np.int64)
        # a longer "word" is cut into pieces, so that nothing is left out
        pieces = -(-(ends - starts) // LONGEST)
        self.doc = np.repeat(owner, pieces)
        within = np.arange(len(self.doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + within * LONGEST
        ends = np.minimum(starts + LONGEST, np.repeat(ends, pieces))
        sums = np.zeros(len(letters) + 1, dtype=np.uint64)
        powers = np.full(len(letters), BASE, dtype=np.uint64)
        powers[:1] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        inverse = np.full(len(letters) + 1, pow(int(BASE), -1, 2**64), dtype=np.uint64)
        inverse[:1] = 1
        inverse = np.cumprod(inverse, dtype=np.uint64)
        np.cumsum(letters.astype(np.uint64) * powers, out=sums[1:])
        keys = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        _, chosen, self.word = np.unique(keys, return_index=True, return_inverse=True)
        self.letters, self.starts, self.ends = letters, starts[chosen], ends[chosen]

    def spelled(self) -> list[str]:
        text = self.letters.astype("<u4").tobytes().decode("utf-32-le", "replace")
        return [text[a:b] for a, b in zip(self.starts, self.ends)]


def flat_symbols(letters, starts, ends, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as one symbol array with a border (0) before and after each, and the first and last place of each."""
    sizes = ends - starts + 2
    first = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.int64)
    source = np.arange(len(out)) - np.repeat(first + 1 - starts, sizes)
    border = np.zeros(len(out), dtype=bool)
    border[first] = border[first + sizes - 1] = True
    out[~border] = symbols[letters[source[~border]]]
    return out, first, first + sizes - 1


def features(flat: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each shape: which word, which subsequence, and the weight before normalising."""
    word = np.repeat(np.arange(len(first)), last - first + 1)
    room = np.repeat(last, last - first + 1) - np.arange(len(flat))
    for offsets, weight in SHAPES:
        at = np.flatnonzero(room >= offsets[-1])
        key = np.zeros(len(at), dtype=np.int64)
        for o in offsets:
            key = key * (SYMBOLS + 1) + flat[at + o]
        yield word[at], key, weight


#: Norm of a word by length with borders: its subsequences taken as all different.
NORMS = np.array([max(sum(w * w * max(n - o[-1], 0) for o, w in SHAPES), 1.0) ** 0.5 for n in range(LONGEST + 3)])


class Machine:
    """The trained machine: a weight for each subsequence, a bias and the logistic coefficients."""

    def __init__(self, alphabet: dict[int, int], keys: np.ndarray, weights: np.ndarray, bias: float):
        self.alphabet, self.keys, self.weights, self.bias = alphabet, keys, weights, bias
        self.calibration: np.ndarray | None = None
        self._tables = None

    def tables(self):
        if self._tables is None:
            symbols = np.full(0x110000, SYMBOLS, dtype=np.uint8)
            for point, symbol in self.alphabet.items():
                symbols[point] = symbol
            dense = np.zeros((SYMBOLS + 1) ** ORDER, dtype=np.float32)
            dense[self.keys] = self.weights
            self._tables = fold_table(), symbols, dense
        return self._tables

    def margins(self, letters, starts, ends) -> np.ndarray:
        _, symbols, dense = self.tables()
        flat, first, last = flat_symbols(letters, starts, ends, symbols)
        total = np.zeros(len(first))
        for word, key, weight in features(flat, first, last):
            total += weight * np.bincount(word, weights=dense[key], minlength=len(first))
        return total / NORMS[last - first + 1] + self.bias

    def summaries(self, texts: list[str]) -> np.ndarray:
        """For each text the largest margin, the second largest, log(1 + words beyond the border), log(1 + words).

        The last one is there because the largest of many margins is large by chance: in a
        long text the same margin says less.
        """
        found = TextWords(texts, self.tables()[0])
        out = np.zeros((len(texts), 4))
        out[:, :2] = -2.0
        if len(found.word):
            margin = self.margins(found.letters, found.starts, found.ends)[found.word]
            order = np.lexsort((-margin, found.doc))
            doc, margin = found.doc[order], margin[order]
            begin = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            out[doc[begin], 0] = margin[begin]
            second = begin + 1
            second = second[second < len(doc)]
            second = second[doc[second] == doc[second - 1]]
            out[doc[second], 1] = margin[second]
            out[:, 2] = np.log1p(np.bincount(doc[margin > 0], minlength=len(texts)))
        out = np.clip(out, -2.0, 8.0)
        if len(found.word):
            out[:, 3] = np.log1p(np.bincount(doc, minlength=len(texts)))
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.calibration is None:
            return np.zeros(len(texts))
        z = self.summaries(texts) @ self.calibration[1:] + self.calibration[0]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float, steps: int = 25) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps; y is -1 or 1."""
    full = np.hstack((x, np.ones((len(x), 1))))
    w = np.zeros(full.shape[1])
    ridge = np.append(np.ones(x.shape[1]), 1e-3)
    for _ in range(steps):
        slack = 1 - y * (full @ w)
        active = slack > 0
        part = full[active] * weight[active, None]
        gradient = ridge * w - cost * part.T @ (y[active] * slack[active])
        step = np.linalg.solve(np.diag(ridge) + cost * part.T @ full[active], gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 40) -> np.ndarray:
    """Coefficients of a logistic regression, the constant first."""
    full = np.hstack((np.ones((len(x), 1)), x))
    w = np.zeros(full.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -40, 40)))
        gradient = full.T @ (p - y) + ridge * w
        hessian = (full * (p * (1 - p))[:, None]).T @ full + (ridge + 1e-6) * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def cover(docs_of: dict[str, list[int]], times: int = 3, common: float = 0.01) -> list[str]:
    """Few words that together occur in all toxic documents that any word can cover.

    Each document is covered up to ``times`` times. Beyond the first time a word
    must add ``common`` of all documents, so that many insults are learned but not
    the other rare words of a group of near copies.
    """
    seen: Counter = Counter()
    least = max(5, common * len({d for docs in docs_of.values() for d in docs}))
    heap = [(-len(docs), w) for w, docs in docs_of.items()]
    heapq.heapify(heap)
    chosen = []
    while heap:
        size, word = heapq.heappop(heap)
        first = sum(seen[d] == 0 for d in docs_of[word])
        fresh = sum(seen[d] < times for d in docs_of[word])
        worth = fresh if fresh >= least else first
        if worth < 2:
            continue
        if worth < -size:
            heapq.heappush(heap, (-worth, word))
            continue
        chosen.append(word)
        seen.update(docs_of[word])
    return chosen


def train_machine(toxic: dict[str, float], clean: dict[str, float], landmarks: int = LANDMARKS) -> Machine:
    """The machine that tells the words of toxic sentences from those of clean ones."""
    counts = Counter()
    for words in (toxic, clean):
        for w in words:
            counts.update(w)
    alphabet = {ord(c): k + 1 for k, (c, _) in enumerate(counts.most_common(SYMBOLS - 1))}
    symbols = np.full(0x110000, SYMBOLS, dtype=np.uint8)
    for point, symbol in alphabet.items():
        symbols[point] = symbol
    words = [*toxic, *clean]
    letters, offsets = code_points(words)
    flat, first, last = flat_symbols(letters, offsets[:-1], offsets[1:], symbols)
    rows, keys, values = (np.concatenate(p) for p in zip(*((w, k, np.full(len(k), v)) for w, k, v in features(flat, first, last))))
    values = values / NORMS[last - first + 1][rows]
    half = landmarks // 2
    step = max(1, len(clean) // (landmarks - min(half, len(toxic))))
    marks = np.array([*range(min(half, len(toxic))), *range(len(toxic), len(words), step)][:landmarks])
    place = np.full(len(words), -1)
    place[marks] = np.arange(len(marks))
    on = place[rows] >= 0
    known, column = np.unique(keys[on], return_inverse=True)
    z = np.zeros((len(marks), len(known)))
    np.add.at(z, (place[rows[on]], column), values[on])
    at = np.searchsorted(known, keys)
    at[at == len(known)] = 0
    shared = known[at] == keys if len(known) else np.zeros(len(keys), dtype=bool)
    kernel = np.zeros((len(words), len(marks)))
    for a in range(0, len(words), 2000):
        b = min(a + 2000, len(words))
        use = shared & (rows >= a) & (rows < b)
        x = np.zeros((b - a, len(known)), dtype=np.float32)
        np.add.at(x, (rows[use] - a, at[use]), values[use])
        kernel[a:b] = x @ z.T
    root, spectrum, _ = np.linalg.svd(kernel[marks])
    whiten = root @ np.diag(1 / np.sqrt(np.maximum(spectrum, 1e-6))) @ root.T
    y = np.append(np.ones(len(toxic)), -np.ones(len(clean)))
    weight = np.array([*toxic.values(), *clean.values()])
    for side in (y > 0, y < 0):
        weight[side] *= len(y) / (2 * weight[side].sum())
    w, bias = squared_hinge(kernel @ whiten, y, weight, cost=2.0)
    return Machine(alphabet, known, (z.T @ (whiten @ w)).astype(np.float32), bias)


def sample(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc, toxic, text) of about ``train_docs`` documents of each label, with repeated texts once.

    The drawn labels are narrow and at most about twice ``train_docs`` rows, so
    they may be broadcast and no text is shuffled for the join.
    """
    each = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in each.groupBy("toxic").count().collect()}
    share = F.lit(0.0)
    for label, size in sizes.items():
        share = F.when(F.col("toxic") == label, F.lit(min(1.0, train_docs / size))).otherwise(share)
    drawn = each.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return texts.select(F.xxhash64("text").alias("doc"), "toxic", F.coalesce("text", F.lit("")).alias("text"))


def word_rows(texts: DataFrame, table_of=fold_table) -> DataFrame:
    """(doc, toxic, word): each distinct word of each text."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = table_of()
        for batch in batches:
            for a, b in chunks(batch["text"].tolist(), CHUNK):
                part = batch.iloc[a:b]
                found = TextWords(part["text"].tolist(), table)
                pairs = np.unique(found.doc * max(len(found.starts), 1) + found.word)
                doc, word = np.divmod(pairs, max(len(found.starts), 1))
                spelled = np.array(found.spelled(), dtype=object)
                yield pd.DataFrame(
                    {"doc": part["doc"].to_numpy()[doc], "toxic": part["toxic"].to_numpy()[doc], "word": spelled[word] if len(spelled) else []}
                )

    return texts.mapInPandas(split, "doc long, toxic int, word string")


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Machine | None:
    """The machine learned from labelled rows; None if only one label occurs."""
    ensure_checkpoint_dir(docs.sparkSession)
    # a bounded sample that everything below reads again and again
    texts = sample(docs, labels, train_docs).withColumn("toxic", F.col("toxic").cast("int")).checkpoint()
    rows = word_rows(texts).distinct().checkpoint()
    counted = rows.groupBy("word").agg(
        F.sum("toxic").alias("n_toxic"), F.sum(1 - F.col("toxic")).alias("n_clean"),
        F.slice(F.array_sort(F.collect_set(F.when(F.col("toxic") == 1, F.col("doc")))), 1, train_docs).alias("docs"),
    )
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count_distinct("doc").alias("n")).collect()}
    rate = lambda n, label: (F.col(n) + 0.5) / (sizes.get(label, 0) + 1.0)
    rare_in_clean = (F.col("n_clean") == 0) | (rate("n_toxic", 1) >= LEAST_RATIO * rate("n_clean", 0))
    candidate = (F.col("n_toxic") >= 2) & rare_in_clean
    hinted = counted.filter(candidate).orderBy(F.desc("n_toxic"), "word").limit(MAX_CANDIDATES).collect()
    clean_words = counted.filter((F.col("n_clean") > 0) & ~candidate).select("word", "n_clean")
    often = clean_words.orderBy(F.desc("n_clean"), "word").limit(MAX_CLEAN // 2).collect()
    rare = clean_words.orderBy(F.xxhash64("word"), "word").limit(MAX_CLEAN // 2).collect()
    positive = cover({r["word"]: r["docs"] for r in hinted})
    clean = {r["word"]: float(np.log1p(r["n_clean"])) for r in [*often, *rare]}
    if not positive or not clean:
        return None
    size = {r["word"]: r["n_toxic"] for r in hinted}
    machine = train_machine({w: float(np.log1p(size[w])) for w in positive}, clean)
    shared = share(docs.sparkSession.sparkContext, machine)

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in chunks(batch["text"].tolist(), CHUNK):
                part = batch.iloc[a:b]
                found = held(shared).summaries(part["text"].tolist())
                yield pd.DataFrame({"toxic": part["toxic"]} | {c: found[:, k] for k, c in enumerate(SUMMARY)})

    schema = ", ".join(["toxic int", *[f"{c} double" for c in SUMMARY]])
    known = texts.mapInPandas(summarise, schema).toPandas().sort_values(["toxic", *SUMMARY])
    machine.calibration = logistic(known[SUMMARY].to_numpy(), known["toxic"].to_numpy().astype(float))
    machine._tables = None
    return machine


def score(docs: DataFrame, machine: Machine | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``."""
    shared = share(docs.sparkSession.sparkContext, machine)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            found = np.zeros(len(texts))
            for a, b in chunks(texts, CHUNK):
                if held(shared) is not None:
                    found[a:b] = held(shared).scores(texts[a:b])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": found, "predicted": (found >= THRESHOLD).astype("int32")})

    kind = dict(docs.dtypes)[doc_id]
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInPandas(run, f"doc_id {kind}, score double, predicted int")
