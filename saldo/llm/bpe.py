"""Byte-level BPE encoding and decoding by backtracking over longest matches.

A sequence of tokens is the BPE encoding of its bytes exactly if every token is
its own encoding and every two neighbours, taken alone, are theirs. So an
encoder need not merge: it walks along the text, takes the longest token that
starts there and is compatible with the token before it, and steps back where it
cannot go on. A position that led nowhere is never entered again, which keeps
the walk linear in the text.

Matches come from an Aho-Corasick automaton over tokens whose bytes are written
as Latin-1 characters. Compatibility of two tokens is worked out from their merge
histories once and remembered, as are the ids of recent pieces, both in bounded
tables.

Defined results: a null text counts as empty; an empty text has no ids and the
digest of the empty string; rows repeat as often as in the input; text of any
length is encoded whole, one row at a time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.shared import held, share
from saldo.llm.textarrays import chunks

MAX_PIECES, MAX_PAIRS, CHUNK = 250_000, 250_000, 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class Codec:
    """Encoder and decoder for one vocabulary; everything derived is made on first use."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self._ready = False

    def _prepare(self) -> None:
        import ahocorasick
        import regex

        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"bytes missing from the vocabulary: {missing}")
        self.split = regex.compile(self.pattern).findall
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.span = max(self.token) + 1
        self.size = {rank: len(token) for rank, token in self.token.items()}
        self.by_text = {str(rank): token for rank, token in self.token.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        self.automaton.make_automaton()
        self.edges: tuple[dict, dict] = ({}, {})
        self.histories: dict[int, tuple[int, int] | None] = {}
        self.shorter: dict[int, int] = {}
        self.pairs: dict[int, bool] = {}  # by left * number of tokens + right
        self.pieces: dict[str, str] = {}
        self._ready = True

    def made_from(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if rank in self.histories:
            return self.histories[rank]
        parts = [self.token[rank][k : k + 1] for k in range(len(self.token[rank]))]
        while len(parts) > 2:
            joined = [self.ranks.get(a + b, rank) for a, b in zip(parts, parts[1:])]
            low = min(joined)
            if low >= rank:
                raise ValueError(f"token {rank} cannot be made by merges")
            at = joined.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        made = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        self.histories[rank] = made
        return made

    def _edge(self, rank: int, side: int) -> list[tuple[bytes, int]]:
        """Tokens that lie at one edge while this token grows, each with the rank that ends it."""
        known = self.edges[side].get(rank)
        if known is None:
            known, until, at = [], len(self.ranks), rank
            while True:
                known.append((self.token[at], until))
                made = self.made_from(at)
                if made is None:
                    break
                until, at = at, made[side]
            self.edges[side][rank] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge across the border of two tokens comes before their own merges.

        Merges go by rank, and from left to right within a rank: at equal rank the
        left token's own merge comes first, the right one's comes later.
        """
        key = left * self.span + right
        known = self.pairs.get(key)
        if known is not None:
            return known
        rank_of = self.ranks.get
        rights = self._edge(right, 0)
        good = not any(
            (across := rank_of(a + b)) is not None and across < a_until and across <= b_until
            for a, a_until in self._edge(left, 1)
            for b, b_until in rights
        )
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        self.pairs[key] = good
        return good

    def next_shorter(self, rank: int) -> int:
        """The longest other token that this token begins with, or -1."""
        if rank not in self.shorter:
            token = self.token[rank]
            starts = (self.ranks.get(token[:n], -1) for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((r for r in starts if r >= 0), -1)
        return self.shorter[rank]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of the bytes as one unit, without splitting by the pattern."""
        if not piece:
            return []
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = [-1] * len(piece)
        for end, (before, rank) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - before] = rank  # ends ascend, so the last is the longest
        size, known, shorter, span = self.size, self.pairs.get, self.next_shorter, self.span
        dead: set[int] = set()
        out = [longest[0]]
        at, stop = size[longest[0]], len(piece)
        last = longest[0]
        now = longest[at]
        while True:
            end = at + size[now]
            good = known(last * span + now)
            if good is None:
                good = self.compatible(last, now)
            if good and end not in dead:
                out.append(now)
                if end == stop:
                    return out
                at, last, now = end, now, longest[end]
                continue
            now = shorter(now)
            while now < 0:  # nothing fits here: give up the last token and this position
                dead.add(at)
                out.pop()
                at -= size[last]
                now = shorter(last)
                last = out[-1] if out else -1
            if last < 0:
                out, last, at = [now], now, at + size[now]
                now = longest[at]

    def _ids_text(self, piece: str) -> str:
        ids = " ".join(map(str, self.encode_piece(piece.encode("utf-8"))))
        if len(piece) <= 64:
            if len(self.pieces) >= MAX_PIECES:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def encode_text(self, text: str) -> str:
        """Decimal ids joined by one blank."""
        if not self._ready:
            self._prepare()
        known, make = self.pieces.get, self._ids_text
        return " ".join([known(piece) or make(piece) for piece in self.split(text)])

    def decode_text(self, ids: str) -> bytes:
        """The bytes of decimal ids joined by one blank."""
        if not self._ready:
            self._prepare()
        return b"".join(map(self.by_text.__getitem__, ids.split(" "))) if ids else b""


def encode(docs: DataFrame, codec: Codec, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    return _rows(docs, codec, doc_id, text, "ids array<int>", lambda c, t: ([int(x) for x in c.encode_text(t).split()],))


def decode(coded: DataFrame, codec: Codec, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, data binary) of every row of ids; a null array counts as empty."""
    joined = coded.select(F.col(doc_id).alias("doc_id"), F.array_join(ids, " ").alias("text"))
    return _rows(joined, codec, "doc_id", "text", "data binary", lambda c, t: (c.decode_text(t),))


def encoded(docs: DataFrame, codec: Codec, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256): the ids with the digests of ``round_trip``."""

    def work(c: Codec, t: str) -> tuple:
        ids = c.encode_text(t)
        numbers = np.array(ids.split(), dtype=np.int32)
        return numbers, len(numbers), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(c.decode_text(ids)).hexdigest()

    return _rows(docs, codec, doc_id, text, "ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string", work)


def round_trip(docs: DataFrame, codec: Codec, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the bytes decoded from them."""

    def digests(c: Codec, t: str) -> tuple[int, str, str]:
        ids = c.encode_text(t)
        count = ids.count(" ") + 1 if ids else 0
        return count, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(c.decode_text(ids)).hexdigest()

    return _rows(docs, codec, doc_id, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


def _rows(docs: DataFrame, codec: Codec, doc_id: str, text: str, schema: str, work) -> DataFrame:
    shared = share(docs.sparkSession.sparkContext, codec)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for x, y in chunks(texts, CHUNK):
                done = [work(held(shared), t) for t in texts[x:y]]
                out = {"doc_id": batch["doc_id"].iloc[x:y].reset_index(drop=True)}
                for k, n in enumerate(names):
                    out[n] = pd.Series([d[k] for d in done], dtype="int64" if n == "n_tokens" else object)
                yield pd.DataFrame(out)

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInPandas(run, f"doc_id {dict(docs.dtypes)[doc_id]}, {schema}")
