"""Odd rows for every operator: nulls, empty and long texts, repeats, empty tables, clashing columns."""

import hashlib
import random

import public_tokenizers
import pytest

import corpus_pipeline
from saldo.llm import bpe, decontam, hostrules, langid, linededup, neardup, pii, quotes, toxicity, warc

WORDS = "the and with from that this have will your house garden water tree stone river light music paper".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, seed=1):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n))


LONG = prose(60_000)
TEXTS = [(1, prose(80)), (2, None), (3, ""), (4, "   \n\t"), (None, prose(80, 2)), (5, prose(80, 3)), (5, prose(80, 3)),
         (6, LONG), (7, "12345 !!!"), (8, "one"), (9, "x" * 30_000)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if t else None, None if i == 8 else "s", len(t or "")) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clash(odd):
    """Columns with the names that operators use inside and in their results."""
    names = ["row", "site", "lines", "line", "body", "h", "n", "score", "bucket", "class_id", "label", "found", "kept", "depth"]
    for name in names:
        odd = odd.withColumn(name, odd.doc_id)
    return odd


def keyed(rows):
    return sorted(map(tuple, rows), key=repr)


def test_line_dedup(spark, odd, empty, clash):
    shared = [(i, f"menu\nown {i}\n\n menu ", "en", "a" if i < 8 else "b", 9) for i in range(10)]
    docs = spark.createDataFrame([*shared, (20, None, "en", "a", 0), (21, "menu\nx", "en", None, 0)], SCHEMA)
    got = {r.row.doc_id: (r.text_kept, r.lines_dropped) for r in linededup.remove_boilerplate(docs).collect()}
    assert got[0] == ("own 0\n", 2) and got[9] == (shared[9][1], 0)
    assert got[20] == (None, 0) and got[21] == ("menu\nx", 0)
    assert linededup.remove_boilerplate(empty).count() == 0
    assert linededup.remove_boilerplate(clash).count() == len(TEXTS)


def test_language_id(spark, odd, empty, clash):
    rows = [(k, prose(100, k), "en") for k in range(20)] + [(k, prose(100, k)[::-1], "ne") for k in range(20)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert got[1].lang_pred == got[6].lang_pred == "en"
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (2, 3, 4, 7))
    assert keyed(langid.predict(odd, model).collect()) == keyed(langid.predict(clash, model).collect())
    assert langid.predict(empty, model).count() == 0
    nothing = langid.fit(empty)
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}


def test_suffix_automaton_accepts_exactly_the_substrings():
    text = [1, 2, 1, 1, 3, 2, 1, 2, 1]
    moves = langid.suffix_automaton(text)
    subs = {tuple(text[a:b]) for a in range(len(text)) for b in range(a, len(text) + 1)}

    def walk(state, word):
        yield word
        for s, t in moves[state].items():
            yield from walk(t, (*word, s))

    assert set(walk(0, ())) == subs


def test_parse_counts_longest_phrases():
    import numpy as np

    model = langid.Model({"a": langid.Language(np.array([ord(c) for c in "abcab"], dtype=np.uint32))})
    bits, lettered = model.bits(["abcabcaxb"])  # abcab | ca | x | b
    assert lettered[0] and bits[0][0] == pytest.approx(4 * np.log2(5) / 9)


def test_surrogates(spark, odd, empty, clash):
    text = "Mail a.b@x.org or A.B@X.ORG, card 4041894974608795 = 4041-8949-7460-8795, Anna Schmidt, Иван Петров, 10.1.2.3"
    docs = spark.createDataFrame([(1, text), (2, text), (3, "card 4041894974608796, 300.1.1.1"), (4, None)], "doc_id long, text string")
    got = {r.row.doc_id: r for r in pii.replace_entities(docs, "k").collect()}
    assert got[1].text_clean == got[2].text_clean != text
    assert got[1].kinds == ["email", "email", "card", "card", "name", "name", "ip"]
    words = got[1].text_clean.replace(",", "").split()
    assert words[1].upper() == words[3] and words[5] == words[7].replace("-", "")
    assert sum(d if k % 2 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, words[5]))) % 10 == 0
    assert words[8] in pii.GIVEN["latin_f"] and words[10] in pii.GIVEN["cyrillic_m"]
    accented = pii.replace_entities(spark.createDataFrame([(1, "x éçou.72@mail3.example.com.")], "doc_id long, text string"), "k").first()
    assert accented.kinds == ["email"] and "é" not in accented.text_clean and accented.text_clean.endswith(".example.")
    assert got[3].text_clean == "card 4041894974608796, 300.1.1.1" and got[4].text_clean is None
    assert pii.replace_entities(docs, "other").filter("row.doc_id = 1").first().text_clean != got[1].text_clean
    assert pii.replace_entities(empty, "k").count() == 0
    assert pii.replace_entities(clash, "k").count() == len(TEXTS)


def test_clashing_surrogates_are_drawn_again(spark, monkeypatch):
    from pyspark.sql import functions as F

    real = pii.surrogate

    def narrow(form, kind, key, attempt):
        """One octet only, so that many entities clash."""
        return F.when(attempt < 2, F.concat(F.lit("1.1.1."), F.substr(real(form, kind, key, attempt), F.lit(1), F.lit(1)))).otherwise(
            real(form, kind, key, attempt)
        )

    monkeypatch.setattr(pii, "surrogate", narrow)
    rows = [(k, f"host 9.9.{k // 10}.{k % 10} and 9.9.{k // 10}.{k % 10}") for k in range(30)]
    out = pii.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    pairs = [r.text_clean.split()[1::2] for r in out]
    assert all(a == b for a, b in pairs) and len({a for a, _ in pairs}) == 30


def test_surrogates_of_other_scripts(spark):
    names = ["李小龙", "たなか", "محمد", "דניאל", "कविता", "علی۱۲", "김철수", "ສົມ"]
    docs = spark.createDataFrame([(k, f"x {n}@mail3.example.com y") for k, n in enumerate(names)], "doc_id long, text string")
    got = {r.row.doc_id: r for r in pii.replace_entities(docs, "k").collect()}
    for k, n in enumerate(names):
        user = got[k].text_clean.split()[1].split("@")[0]
        assert got[k].kinds == ["email"] and user and sum(a == b for a, b in zip(n, user)) <= 1 and n not in got[k].text_clean
    assert all("\u4e00" <= c <= "\u9fff" for c in got[0].text_clean.split()[1].split("@")[0])


def test_redrawing_ends_in_small_spaces(spark):
    rows = [(1, "Password: ________ and token=--------"), (2, " ".join(f"token={d}_______" for d in range(10)))]
    rows += [(3 + k, f"mail {c}@x.org") for k, c in enumerate("abcdefghijklmnopqrstuvwxyzéñüöä")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.row.doc_id: r for r in pii.replace_entities(docs, "k").collect()}
    assert got[1].text_clean == rows[0][1] and got[1].kinds == []
    secrets = [x.split("=")[1] for x in got[2].text_clean.split()]
    assert len(set(secrets)) == 10 and not {f"{d}_______" for d in range(10)} & set(secrets)
    assert len({got[k].text_clean for k, _ in rows[2:]}) == len(rows) - 2


def test_archives(spark, tmp_path):
    big = "<p>" + "é" * 200
    rows = [(3, "u", big), (1, "u\nx%", big), (2, None, big), (4, "u", None), (5, "u", "tiny"), (6, "u", "tiny"), (7, "u", LONG * 3), (None, "u", big), (1, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index, folder = warc.archive(pages)
    got = warc.read_archives(index, folder).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got)
    assert kinds == [(0, "revisit", 1), (1, "response", None), (1, "response", None), (2, "revisit", 1), (3, "revisit", 1)] + [
        (k, "response", None) for k in (4, 5, 6, 7)
    ]
    for r in got:
        html = {i: h for i, _, h in rows}[r.page_id] or ""
        assert r.payload_digest == hashlib.sha256(html.encode()).hexdigest() and r.payload_bytes == len(html.encode())
        assert r.record_type == "revisit" or bytes(r.payload).decode() == html
    assert "u\nx%" in {r.url for r in got if r.page_id == 1}
    index, folder = warc.archive(pages.limit(0))
    assert warc.read_archives(index, folder).count() == 0


def test_bundle_is_read_by_seeking(tmp_path):
    import io
    import os

    import zstandard

    stream, records = io.BytesIO(), [os.urandom(1000 * (k % 7) + 1) for k in range(500)]
    bundle = warc.BundleWriter(stream)
    places = [bundle.add(r) for r in records]
    bundle.close()
    reader = warc.BundleReader(stream)
    assert len(reader.places) > 3
    order = list(range(500))
    random.Random(1).shuffle(order)
    assert all(reader.record(*places[k], len(records[k])) == records[k] for k in order)
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(stream.getvalue()), read_across_frames=True).read()
    assert plain == b"".join(records)


def test_near_duplicates(spark, odd, empty, clash):
    words = prose(200, 9).split()
    rows = [(10 + k, " ".join(words[:k] + [f"edit{k}"] + words[k:])) for k in range(0, 160, 4)]
    rows += [(400, " ".join(words)), (401, " ".join(words)), (402, "  ".join(words)), (500, prose(200, 10))]
    got = {r.doc_id: r.class_id for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {c for i, c in got.items() if i != 500} == {10} and got[500] == 500
    out = [(r.doc_id, r.class_id) for r in neardup.classes(clash).collect()]
    assert sorted(out, key=repr) == sorted(((i, i) for i, _ in TEXTS), key=repr)
    assert neardup.classes(empty).count() == 0


def test_links_through_a_chain_are_not_lost(spark):
    """Each text is near the next one only; all share bands with some others."""
    words = prose(400, 11).split()
    chain = []
    for k in range(40):
        words = words[:]
        words[k * 9 : k * 9 + 2] = [f"n{k}", f"m{k}"]
        chain.append((k, " ".join(words)))
    got = {r.class_id for r in neardup.classes(spark.createDataFrame(chain, "doc_id long, text string")).collect()}
    assert got == {0}


def test_decontamination(spark, odd, empty, clash):
    item = prose(40, 20)
    edited = item.split()
    edited[7:8] = ["wrong"]
    edited.insert(20, "extra")
    docs = spark.createDataFrame(
        [(1, prose(50, 21) + " " + item + " " + prose(20, 22)), (2, " ".join(edited).upper()), (3, prose(300, 23)), (4, None), (5, LONG + " " + item)],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(7, item), (8, ""), (9, None), (7, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontam.matches(docs, items).collect()}
    assert set(got) == {(1, 7), (2, 7), (5, 7)} and got[1, 7] == got[5, 7] == 0 < got[2, 7]
    assert decontam.matches(empty, items).count() == 0 and decontam.matches(docs, items.limit(0)).count() == 0
    assert decontam.matches(clash, items).count() == 0


def test_short_items_are_found_at_every_place():
    words = [f"{a}{b}zq" for a in ("kor", "vel", "mun", "tab") for b in ("ira", "osel")]
    filler = prose(40, 77).split()
    for n in range(1, 8):
        item = " ".join(words[:n])
        index = decontam.ItemIndex([(7, item), (8, "量子力学入門")])
        texts = [" ".join([*filler[:at], item, *filler[at:]]) for at in range(9)]
        assert {(d, i) for d, i, distance in index.matches(texts, 0.2) if distance == 0} == {(d, 7) for d in range(9)}
        edited = [t.replace(words[0], words[0][:2] + "x" + words[0][3:]) for t in texts]
        assert {(d, i, k) for d, i, k in index.matches(edited, 0.2)} == {(d, 7, 1) for d in range(9)}
        assert index.matches([f"({item})", "これは量子力学入門です", "a量子力x入門b"], 0.2) == [(0, 7, 0), (1, 8, 0), (2, 8, 1)]
    cat = decontam.ItemIndex([(1, "cat"), (2, "")])
    assert cat.matches(["concatenate", "a cat.", "CAT", "", " "], 0.2) == [(1, 1, 0), (2, 1, 0)]


def test_edit_distance_equals_dynamic_programming():
    draw = random.Random(4)
    for _ in range(200):
        item = "".join(draw.choice("ab ") for _ in range(draw.randint(1, 9)))
        text = "".join(draw.choice("ab ") for _ in range(draw.randint(0, 14)))
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        assert decontam.best_distance(item, text) == min(row)


def test_byte_bpe(spark, odd, empty, clash):
    codec = bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in bpe.round_trip(odd, codec).collect()}
    assert got[2].n_tokens == got[3].n_tokens == 0 and got[2].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert all(got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for i, t in TEXTS)
    assert bpe.round_trip(odd, codec).count() == len(TEXTS) and bpe.round_trip(empty, codec).count() == 0
    back = {r.doc_id: bytes(r.data).decode() for r in bpe.decode(bpe.encode(clash, codec), codec).collect()}
    assert all(back[i] == (t or "") for i, t in TEXTS)


def test_toxicity(spark, odd, empty, clash):
    insults = ["zanker", "brofix", "quodel"]
    rows, labels = [], []
    for k in range(240):
        bad = k % 3 == 0
        body = prose(30, k).split()
        if bad:
            body.insert(k % 25, insults[k % 9 // 3])
        rows.append((k, " ".join(body)))
        labels.append((k, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.fit(docs, marks)
    tests = [(1, "you zanker there"), (2, "you z.a.n.k.e.r there"), (3, "you q u o d e l there"), (4, "you brofiix there"), (5, "the water and stone"), (6, ""), (7, None)]
    got = {r.doc_id: r.predicted for r in toxicity.score(spark.createDataFrame(tests, "doc_id long, text string"), machine).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 0, 6: 0, 7: 0}
    assert toxicity.score(clash, machine).count() == len(TEXTS) and toxicity.score(empty, machine).count() == 0
    nothing = toxicity.fit(docs, marks.filter("toxic = 0"))
    assert nothing is None and {r.score for r in toxicity.score(odd, nothing).collect()} == {0.0}


def test_toxicity_learns_from_labels_with_a_few_errors(spark):
    insults = ["zanker", "brofix", "quodel"]
    rows, labels = [], []
    for k in range(300):
        bad = k % 3 == 0
        body = prose(30, k).split()
        if bad:
            body.insert(k % 25, insults[k % 9 // 3])
        rows.append((k, " ".join(body)))
        labels.append((k, int(bad) if k >= 15 else int(not bad)))
    machine = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    tests = [(k, f"you {w} there") for k, w in enumerate(insults)] + [(10, "the water and stone"), (11, prose(40, 999))]
    got = {r.doc_id: r.predicted for r in toxicity.score(spark.createDataFrame(tests, "doc_id long, text string"), machine).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 10: 0, 11: 0}


def test_kernel_weights_equal_the_plain_sum():
    import itertools

    import numpy as np

    words = ["abca", "abxca"]
    letters, offsets = toxicity.code_points(words)
    symbols = np.full(0x110000, toxicity.SYMBOLS, dtype=np.uint8)
    for k, c in enumerate("abcx", 1):
        symbols[ord(c)] = k
    flat, first, last = toxicity.flat_symbols(letters, offsets[:-1], offsets[1:], symbols)
    got = {}
    for word, key, weight in toxicity.features(flat, first, last):
        for w, k in zip(word.tolist(), key.tolist()):
            got[w, k] = got.get((w, k), 0) + weight
    want = {}
    for w, text in enumerate(words):
        coded = [0, *[" abcx".index(c) for c in text], 0]
        for at in itertools.combinations(range(len(coded)), toxicity.ORDER):
            span = at[-1] - at[0] + 1
            if span <= toxicity.SPAN:
                key = 0
                for p in at:
                    key = key * (toxicity.SYMBOLS + 1) + coded[p]
                want[w, key] = want.get((w, key), 0) + toxicity.DECAY ** (span - toxicity.ORDER)
    assert got == pytest.approx(want)


def test_host_rules(spark, odd, empty, clash):
    good = [(k, prose(80, k), "en", "good", 0) for k in range(40)]
    bad = [(100 + k, "spam " * 60, "en", "bad", 0) for k in range(40)] + [(150, prose(80, 50), "en", "bad", 0)]
    few = [(200, prose(80, 60), "en", "few", 0), (201, None, "en", "few", 0), (202, prose(80, 61), "en", None, 0)]
    got = {r.doc_id: r for r in hostrules.judge(spark.createDataFrame(good + bad + few, SCHEMA)).collect()}
    assert all(got[k].kept for k in range(40)) and got[200].kept and got[202].kept
    assert not got[150].base_failed and not got[150].kept
    assert got[201].n_words == 0 and got[201].base_failed
    assert hostrules.judge(clash).count() == len(TEXTS) and hostrules.judge(empty).count() == 0


def test_quotation_linking(spark):
    first, second = "Hello all, this is a first message for the list.", "A short answer to the first message of the list."
    rows = [
        ("t", 1, first), ("t", 2, f"Ann wrote:\n> {first}\n\n{second}"), ("t", 3, f">> {first}\n> {second}\nAgreed."),
        ("t", 4, f"> {second[:10]}\nNo such quote"), ("u", 5, f"> {first.upper()}\nElsewhere"), ("u", 6, None), ("u", 7, ""), (None, 8, first),
        ("t", 2, f"Ann wrote:\n> {first}\n\n{second}"),
    ]
    docs = spark.createDataFrame(rows, "thread string, place long, text string").selectExpr("*", "place as depth", "thread as best")
    got = {(r.row.thread, r.row.place): r for r in quotes.conversations(docs, "thread", "place", "text").collect()}
    links = {k: (r.parent_thread, r.parent_place, r.root_thread, r.root_place, r.depth) for k, r in got.items()}
    assert links["t", 2] == ("t", 1, "t", 1, 1) and links["t", 3] == ("t", 2, "t", 1, 2)
    assert links["t", 4] == (None, None, "t", 4, 0) and links["u", 5] == ("t", 1, "t", 1, 1)
    assert links["u", 6][4] == links["u", 7][4] == links[None, 8][4] == 0
    assert got["t", 2].own_text == second and got["t", 3].own_text == "Agreed." and got["u", 6].own_text == ""
    assert quotes.conversations(docs, "thread", "place", "text").count() == len(rows)
    assert quotes.conversations(docs.limit(0), "thread", "place", "text").count() == 0


def test_pipeline_stages_equal_plain_versions(spark, odd, empty):
    sf = "/root/testdata/sf0.001"
    docs = corpus_pipeline.table(spark, sf, "documents")
    kept = corpus_pipeline.language_id(spark, docs, sf)
    assert kept.columns == corpus_pipeline.COLUMNS and kept.count() >= 0.98 * docs.count()
    unique = corpus_pipeline.near_dedup(spark, docs, sf)
    classes = {r.class_id for r in neardup.classes(docs).collect()}
    assert sorted(r.doc_id for r in unique.collect()) == sorted(classes)
    clean = corpus_pipeline.decontaminate(spark, docs, sf)
    leaks = {r.doc_id for r in decontam.matches(docs, corpus_pipeline.table(spark, sf, "benchmark")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - leaks and leaks
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, sf).columns == corpus_pipeline.COLUMNS, name
        assert stage(spark, empty, sf).count() == 0, name
    assert corpus_pipeline.near_dedup(spark, odd, sf).count() == len(TEXTS) - 1
    assert corpus_pipeline.byte_bpe(spark, empty, sf).count() == 0
    cut = {r.doc_id: r for r in corpus_pipeline.line_dedup(spark, docs, sf).collect()}
    assert all(r.n_chars == len(r.text) for r in cut.values())


def test_whole_pipeline(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert rows and all(len(r.ids) == r.n_tokens for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)


def test_pipeline_keeps_one_document_of_many_copies(spark):
    """A third of a source are exact copies of one text, near copies of another are as many; a menu is on every page."""
    draw = random.Random(31)
    exact, near = ([" ".join(f"{name}{draw.randrange(9999)}" for _ in range(12)) for _ in range(20)] for name in "en")
    rows = [(k, "menu home about\n" + "\n".join(" ".join(f"w{draw.randrange(9999)}" for _ in range(12)) for _ in range(20))) for k in range(40)]
    rows += [(100 + k, "menu home about\n" + "\n".join(exact)) for k in range(40)]
    rows += [(200 + k, "\n".join(["menu home about", *near[: k % 20], f"edit {k} here", *near[k % 20 + 1 :]])) for k in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "one", len(t)) for i, t in rows], SCHEMA)
    cut = corpus_pipeline.line_dedup(spark, docs, "").checkpoint()
    got = {r.doc_id: r.text for r in corpus_pipeline.near_dedup(spark, cut, "").collect()}
    assert all(got[k] == rows[k][1].split("\n", 1)[1] for k in range(40))
    kept = [i for i, t in got.items() if all(x in t for x in exact)]
    assert len(kept) == 1
    assert any(sum(x in t for x in near) >= 19 for t in got.values())
    assert all(t.strip() for t in got.values())
