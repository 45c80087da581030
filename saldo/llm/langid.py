"""Language ID by cross-parsing entropy against suffix automata of labelled text.

A text is parsed from left to right into the longest phrases that occur in a
language's sample. The sample's suffix automaton recognises every substring, so
one transition per character finds the phrases. A phrase costs the logarithm of
the sample's length, and the language with the fewest bits a character wins.

Characters are lower-cased, runs of anything but letters count as one blank. A text is
parsed as a whole. Its blocks of ``BLOCK`` characters first advance together, with those of
all texts of the batch, each from a fresh phrase; then every block is entered again with
the state that the block before it ends in, until both parses meet, which takes some ten
characters. So a very long text is no slower a character than a short one, and phrases go
over the blocks' borders.

A language may have any number of letters: moves by its ``DENSE`` most frequent ones are a
table, and those by rarer ones are looked up among the sorted moves that exist.

Learning takes a bounded sample: ``SAMPLES`` excerpts of at most ``EXCERPT`` characters for
each language, chosen by hash and each from a place in its text that the hash names.
``CHECKS`` further ones say how many phrases a character text of the language needs at
most; a text that needs many more in its best language does not fit. Prediction reads
whole texts of all rows.

Defined results: a null text, or one without letters, is ``und`` with score 0 and fits nothing;
rows repeat in the result as often as in the input; a tie goes to the
alphabetically first language; without labelled rows everything is ``und``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.shared import held, share
from saldo.llm.textarrays import chunks, code_points

SAMPLES, CHECKS, EXCERPT, DENSE, BLOCK = 128, 32, 320, 63, 512
#: A text fits with so many times the phrases of the worst excerpt that was checked, and some more in all.
SLACK, SPARE = 1.5, 12
UNDETERMINED = "und"


def letter_table() -> np.ndarray:
    """For each code point its lower-case form if it is a letter, else 0."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def normalised(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with single blanks (0) between words, and the texts' offsets."""
    points, offsets = code_points(texts)
    folded = letters[points]
    keep = np.ones(len(folded), dtype=bool)
    keep[1:] = (folded[1:] != 0) | (folded[:-1] != 0)
    edges = offsets[:-1][offsets[:-1] < len(folded)]
    keep[edges] = folded[edges] != 0
    position = np.concatenate(([0], np.cumsum(keep)))
    return folded[keep], position[offsets]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts exactly the substrings of ``symbols``."""
    moves: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for s in symbols:
        new = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and s not in moves[at]:
            moves[at][s] = new
            at = link[at]
        if at >= 0:
            target = moves[at][s]
            if longest[target] == longest[at] + 1:
                link[new] = target
            else:  # the target also stands for longer strings: split it
                copy = len(moves)
                moves.append(dict(moves[target]))
                longest.append(longest[at] + 1)
                link.append(link[target])
                while at >= 0 and moves[at].get(s) == target:
                    moves[at][s] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    return moves


class Language:
    """One language's automaton.

    ``table`` holds the moves by frequent letters. States are multiplied by its row width.
    Where a phrase ends it holds the complement of the state that the next phrase, which
    begins with the same letter, is in; so a negative entry both counts a phrase and goes on.
    Column 0 is for letters that the sample does not have. ``keys`` are the moves by rarer
    letters, state by letter, with their ``targets``; ``fresh`` are those of the first state.
    """

    def __init__(self, sample: np.ndarray):
        ranked = [p for p, _ in sorted(Counter(sample.tolist()).items(), key=lambda x: (-x[1], x[0]))]
        self.symbols = {p: k + 1 for k, p in enumerate(ranked)}  # 0: unknown
        coded = [self.symbols[p] for p in sample.tolist()]
        moves = suffix_automaton(coded)
        self.width = width = min(len(ranked), DENSE) + 1
        dead = len(moves)
        first = np.full(width, dead * width, dtype=np.int32)
        for s, target in moves[0].items():
            if s < width:
                first[s] = target * width
        table = np.tile(~first, (dead + 1, 1))
        self.rare = len(ranked) + 1 - width
        rare = []
        for state, out in enumerate(moves):
            for s, target in out.items():
                if s < width:
                    table[state, s] = target * width
                else:
                    rare.append((state * self.rare + s - width, target * width))
        self.table, self.start = table.ravel(), dead * width
        rare.sort()
        self.keys = np.array([k for k, _ in rare], dtype=np.int64)
        self.targets = np.array([t for _, t in rare], dtype=np.int32)
        self.fresh = np.array([moves[0].get(s, 0) * width for s in range(width, len(ranked) + 1)], dtype=np.int32)
        self.phrase_bits = float(np.log2(max(len(coded), 2)))
        self.most = np.inf  # phrases a character in text of the language

    def codes(self, known: list[int]) -> np.ndarray:
        """The language's numbers of letters."""
        return np.array([self.symbols.get(p, 0) for p in known], dtype=np.int32)

    def step(self, state: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The next states, as their complements where a phrase begins."""
        if not self.rare:
            return self.table[state + letters]
        seldom = np.flatnonzero(letters >= self.width)
        after = self.table[state + np.where(letters < self.width, letters, 0)]
        if len(seldom):
            letter = letters[seldom] - self.width
            key = (state[seldom] // self.width).astype(np.int64) * self.rare + letter
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            after[seldom] = np.where(self.keys[at] == key, self.targets[at], ~self.fresh[letter])
        return after


class Blocks:
    """The blocks of a batch's texts, longest first, as a grid of one row for each step."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray):
        lengths = np.diff(offsets)
        per = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(lengths)), per)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        starts = offsets[owner] + within * BLOCK
        sizes = np.minimum(BLOCK, offsets[owner + 1] - starts)
        order = np.argsort(-sizes, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.owner, self.sizes = owner[order], sizes[order]
        later = np.flatnonzero(within > 0)
        #: The blocks that continue a text, and for each block the ones before and after it in its text (-1: none).
        self.later = place[later]
        self.before_of, self.after_of = np.full(len(order), -1), np.full(len(order), -1)
        self.before_of[place[later]], self.after_of[place[later - 1]] = place[later - 1], place[later]
        padded = np.concatenate((codes, np.zeros(BLOCK, dtype=codes.dtype))).astype(np.int32)
        self.grid = np.ascontiguousarray(padded[starts[order][:, None] + np.arange(BLOCK)].T)
        self.alive = np.searchsorted(-self.sizes, -np.arange(BLOCK), side="left")


def _entered(
    language: Language, blocks: Blocks, letters: np.ndarray, block: np.ndarray, state: np.ndarray,
    first: tuple[np.ndarray, np.ndarray], counted: np.ndarray, ends: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Phrases and last states of blocks that are entered in the given states.

    ``first`` has the states and counts after each step of the parse from a fresh phrase,
    ``counted`` and ``ends`` the last ones. Where both parses are in one state they go on alike.
    """
    states, counts = first
    total, last = np.zeros(len(block), dtype=np.int32), np.zeros(len(block), dtype=np.int32)
    left, now, seen = np.arange(len(block)), state, np.zeros(len(block), dtype=np.int32)
    for k in range(BLOCK):
        inside = blocks.sizes[block[left]] > k
        if not inside.all():
            out = left[~inside]
            total[out], last[out] = seen[~inside], now[~inside]
            left, now, seen = left[inside], now[inside], seen[inside]
        if not len(left):
            return total, last
        at = block[left]
        after = language.step(now, letters[blocks.grid[k, at]])
        ended = after >> 31
        seen, now = seen - ended, after ^ ended
        met = states[k, at] == now
        if met.any():
            out = left[met]
            total[out], last[out] = counted[at[met]] + seen[met] - counts[k, at[met]], ends[at[met]]
            left, now, seen = left[~met], now[~met], seen[~met]
    total[left], last[left] = seen, now
    return total, last


def phrases(language: Language, blocks: Blocks, letters: np.ndarray) -> np.ndarray:
    """Phrases that begin in each block when each text is parsed as a whole."""
    n = len(blocks.sizes)
    states, counts = np.zeros((BLOCK, n), dtype=np.int32), np.zeros((BLOCK, n), dtype=np.int32)
    state, count = np.full(n, language.start, dtype=np.int32), np.zeros(n, dtype=np.int32)
    for k in range(BLOCK):
        live = blocks.alive[k]
        if not live:
            break
        after = language.step(state[:live], letters[blocks.grid[k, :live]])
        ended = after >> 31
        count[:live] -= ended
        state[:live] = after ^ ended
        states[k, :live], counts[k, :live] = state[:live], count[:live]
    counted, ends, block = count.copy(), state.copy(), blocks.later
    while len(block):
        total, last = _entered(language, blocks, letters, block, state[blocks.before_of[block]], (states, counts), counted, ends)
        count[block] = total
        changed = block[state[block] != last]
        state[block] = last
        # the block after one that ends otherwise than was assumed is entered anew
        block = blocks.after_of[changed]
        block = block[block >= 0]
    return count


class Model:
    """All languages; big lookup tables are made once in each worker."""

    def __init__(self, languages: dict[str, Language]):
        self.names, self.languages = sorted(languages), languages
        self._letters = None

    def letters(self) -> np.ndarray:
        if self._letters is None:
            self._letters = letter_table()
        return self._letters

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases, text by language, and the texts' lengths in letters and blanks."""
        symbols, offsets = normalised(texts, self.letters())
        known, codes = np.unique(symbols, return_inverse=True)
        blocks = Blocks(codes, offsets)
        out = np.zeros((len(texts), len(self.names)))
        for k, name in enumerate(self.names):
            language = self.languages[name]
            found = phrases(language, blocks, language.codes(known.tolist()))
            out[:, k] = np.bincount(blocks.owner, weights=found, minlength=len(texts))
        return out, np.diff(offsets)

    def bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a character, text by language, and which texts have letters."""
        found, lengths = self.counts(texts)
        cost = np.array([self.languages[n].phrase_bits for n in self.names])
        return found * cost / np.maximum(lengths, 1)[:, None], lengths > 0

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        """Language, score (the winner's lead over the second) and whether the text fits it, for each text."""
        if not self.names:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [False] * len(texts)
        found, lengths = self.counts(texts)
        cost = np.array([self.languages[n].phrase_bits for n in self.names])
        most = np.array([self.languages[n].most for n in self.names])
        bits, lettered = found * cost, lengths > 0
        best = bits.argmin(axis=1)
        ranked = np.sort(bits, axis=1)
        second = ranked[:, 1] if len(self.names) > 1 else np.full(len(texts), np.inf)
        score = 1 - ranked[:, 0] / np.maximum(second, 1e-12)
        names = [self.names[b] if ok else UNDETERMINED for b, ok in zip(best, lettered)]
        fits = found[np.arange(len(texts)), best] <= most[best] * SLACK * lengths + SPARE
        return names, np.where(lettered, np.clip(score, 0, 1), 0.0).tolist(), (fits & lettered).tolist()


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", samples: int = SAMPLES, excerpt: int = EXCERPT) -> Model:
    """Automata from rows with text and language; at most (samples + CHECKS) x excerpt characters a language.

    Each language's texts fall into buckets by hash and each bucket keeps one excerpt, so
    the choice is one aggregate that combines before the shuffle, and copies count once.
    """
    h = F.xxhash64(text)
    room = F.greatest(F.length(text) - excerpt, F.lit(0)) + 1
    part = F.substring(F.col(text), F.pmod(F.xxhash64(h), room).cast("int") + 1, F.lit(excerpt))
    drawn = (
        labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
        .select(F.col(lang).alias("lang"), h.alias("h"), part.alias("part"))
        .groupBy("lang", F.pmod("h", F.lit(samples + CHECKS)).cast("int").alias("bucket"))
        .agg(F.min(F.struct("h", "part")).alias("kept"))
        .select("lang", "bucket", F.col("kept.part").alias("part"))
    )
    letters = letter_table()
    sets: dict[str, list[str]] = {}
    checks: dict[str, list[str]] = {}
    for row in drawn.orderBy("lang", "bucket").collect():
        (sets if row["bucket"] < samples else checks).setdefault(row["lang"], []).append(row["part"])
    for name in checks.keys() - sets.keys():  # too few texts to hold any back
        sets[name] = checks.pop(name)
    fitted = {name: normalised(parts, letters)[0] for name, parts in sets.items()}
    model = Model({name: Language(sample) for name, sample in fitted.items() if len(sample)})
    for name, parts in checks.items():
        if name in model.languages:
            alone = Model({name: model.languages[name]})
            found, lengths = alone.counts(parts)
            long = lengths >= excerpt // 4
            if long.any():
                model.languages[name].most = float((found[long, 0] / lengths[long]).max())
    return model


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, fits) of every row of ``docs``."""
    shared = share(docs.sparkSession.sparkContext, model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            parts = [held(shared).predict(texts[a:b]) for a, b in chunks(texts)]
            columns = {c: [x for p in parts for x in p[k]] for k, c in enumerate(("lang_pred", "score", "fits"))}
            yield pd.DataFrame({"doc_id": batch["doc_id"]} | columns)

    kind = dict(docs.dtypes)[doc_id]
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInPandas(score, f"doc_id {kind}, lang_pred string, score double, fits boolean")


def predicted(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column struct<lang_pred, score, fits> for each row; other columns do not pass through Python.

    Marked as not deterministic, so that a filter on it does not run it twice.
    """
    shared = share(docs.sparkSession.sparkContext, model)

    def score(column: pd.Series) -> pd.DataFrame:
        texts = [t if isinstance(t, str) else "" for t in column]
        parts = [held(shared).predict(texts[a:b]) for a, b in chunks(texts)]
        return pd.DataFrame({c: [x for p in parts for x in p[k]] for k, c in enumerate(("lang_pred", "score", "fits"))})

    score.__annotations__ = {"column": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(score, "lang_pred string, score double, fits boolean").asNondeterministic()(F.col(text))
