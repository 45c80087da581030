"""Registered queries against statements, brute force and held-out labels."""

import hashlib
import os
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from checks.compare import differences, duck
from saldo.llm import bpe, decontam, neardup, queries
from saldo.llm.hostrules import text_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in queries.table(spark, SF, "documents").collect()}


@pytest.mark.parametrize("name", sorted(queries.llm_oracles()))
def test_query_equals_statement(spark, name):
    assert differences(queries.llm_queries()[name](spark, SF), duck(SF), queries.llm_oracles()[name]) == []


def test_thirteen_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.llm_queries()) == list(range(1, 14))
    assert all(q.__doc__ for q in queries.llm_queries().values())


def test_languages_are_right_on_held_out_documents(spark, docs):
    rows = queries.op2_language_id(spark, SF).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.95 * len(held) > 0
    assert all(0 <= r.score <= 1 for r in rows)


def test_no_detected_entity_is_left(spark, docs):
    import re

    shapes = [r"[\w.]+@mail\d\.example\.com", r'token = "[0-9a-f]{40}"', r"\+1 \(\d{3}\) 555-\d{4}", r"password=[0-9a-f]{18}"]
    rows = queries.op3_pii_surrogates(spark, SF).collect()
    mapped = {}
    for r in rows:
        for shape in shapes:
            for found in re.findall(shape, docs[r.doc_id].text):
                assert found not in r.text
        if not r.n_entities:
            assert r.text == docs[r.doc_id].text
        else:
            old = re.findall(r"[\w.]+@[\w.]+\w", docs[r.doc_id].text.lower())
            new = re.findall(r"[\w.]+@[\w.]+\w", r.text.lower())
            for a, b in zip(old, new, strict=True):
                assert mapped.setdefault(a, b) == b
    assert len(set(mapped.values())) == len(mapped) > 0


def test_near_duplicates_equal_brute_force(spark, docs):
    bags = {}
    for i, r in docs.items():
        words = r.text.encode().split()
        n = min(5, len(words))
        bags[i] = Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if n else Counter()
    holders = defaultdict(list)
    for i, bag in bags.items():
        for s in bag:
            holders[s].append(i)
    parent = {i: i for i in docs}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, bag in bags.items():
        shared = Counter()
        for s, c in bag.items():
            for j in holders[s]:
                if j < i:
                    shared[j] += min(c, bags[j][s])
        for j, k in shared.items():
            if k >= 0.8 * (bag.total() + bags[j].total() - k):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    got = {r.doc_id: r.class_id for r in queries.op5_near_duplicates(spark, SF).collect()}
    assert got == {i: top(i) for i in docs} and len(set(got.values())) < len(got)


def test_decontamination_equals_brute_force(spark, docs):
    items = {r.item_id: " ".join(decontam.word_list(r.text)) for r in queries.table(spark, SF, "benchmark").collect()}
    want = set()
    for i, r in docs.items():
        plain = " ".join(decontam.word_list(r.text))
        for k, item in items.items():
            if item in plain or decontam.best_distance(item, plain) <= decontam.MAX_EDITS * len(item):
                want.add((i, k))
    got = {(r.doc_id, r.item_id) for r in queries.op6_decontamination(spark, SF).collect()}
    assert got == want and want


def test_token_ids_equal_the_reference_library(spark, docs):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in queries.op7_byte_bpe(spark, SF).collect():
        ids = other.encode_ordinary(docs[r.doc_id].text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].text.encode()).hexdigest()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the larger tables")
def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.op8_toxicity(spark, sf).filter("held_out").join(queries.table(spark, sf, "labels"), "doc_id")
    table = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    right, missed, wrong = table.get((1, 1), 0), table.get((1, 0), 0), table.get((0, 1), 0)
    assert right >= 0.9 * (right + missed) and wrong <= 0.05 * right


def test_base_counts_equal_the_contract(spark, docs):
    import re

    for r in queries.op9_host_rules(spark, SF).collect():
        text = docs[r.doc_id].text
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        often = Counter(windows)
        covered = {k + o for k, w in enumerate(windows) if often[w] > 1 for o in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r.kept and r.base_failed)


def test_native_queries_run_no_python(spark):
    for name in ("op1_line_dedup", "op3_pii_surrogates", "op10_quotation_linking"):
        plan = queries.llm_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval", "Cartesian"))


def test_text_counts_edge_cases():
    assert text_counts("") == (0, 0, 0, 0, 0, 0)
    assert text_counts("a b c") == (1, 5, 0, 0, 0, 1)
    assert text_counts("x y z x y z") == (6, 6, 0, 0, 6, 1)
    assert text_counts("a a a a") == (4, 4, 0, 0, 4, 1)


def test_signatures_are_unbiased():
    import random

    import numpy as np

    draw = random.Random(7)
    gaps = []
    for _ in range(30):
        one = [f"w{draw.randrange(150)}" for _ in range(draw.choice([20, 300]))] * draw.choice([1, 3])
        two = [w if draw.random() > 0.03 else "new" for w in one]
        texts = [" ".join(one), " ".join(two)]
        times = neardup.signatures(*neardup.bags(texts), 2, 1000)
        gaps.append((times[0] == times[1]).mean() - neardup.overlap(*texts))
    assert abs(np.mean(gaps)) < 0.02
