import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shiftloom.llm import byte_cnn, crf, decontaminate, fm_index, pieces, pii, quality_rules, suffix_tree_lm, tokens
from shiftloom.llm._bytes import chunks, text_buffer
from shiftloom.llm.queries_rules import OP4_SQL
from shiftloom.llm.queries_scan import OP8_SQL
from tests.llm.conftest import prose

LOWER = {k: k + 32 for k in range(65, 91)}


# --- 1 quality classifier --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def weights():
    good, bad = [prose(i, 60) for i in range(150)], [" ".join(w.upper() + "!!" for w in prose(1000 + i, 40).split()) for i in range(75)] + [" ".join([w] * 7) for i in range(75) for w in [prose(2000 + i, 12)]]
    return byte_cnn.fit(pa.array(good + bad), np.array([1] * 150 + [0] * 150, np.float32), epochs=4)


def test_classifier_separates_held_out_texts(weights):
    buf, off = text_buffer(pa.array([prose(5000 + i, 70) for i in range(40)] + [" ".join(w.upper() + "!!" for w in prose(6000 + i, 50).split()) for i in range(40)]))
    s = byte_cnn.score(weights, buf, off)
    assert (s[:40] >= 0.3).mean() > 0.95 and (s[40:] < 0.3).mean() > 0.95


def test_score_does_not_depend_on_neighbours_or_blocks(weights, monkeypatch):
    t = [prose(i, 10 * i) for i in range(12)] + ["", None]
    buf, off = text_buffer(pa.array(t))
    together = byte_cnn.score(weights, buf, off)
    alone = [byte_cnn.score(weights, *text_buffer(pa.array([x], pa.string())))[0] for x in t]
    assert np.allclose(together, alone, atol=1e-5)
    monkeypatch.setattr(byte_cnn, "SLICE_ROWS", 128)
    assert np.allclose(byte_cnn.score(weights, buf, off), together, atol=1e-5)


def test_gradient_agrees_with_differences():
    rng = np.random.default_rng(0)
    w = byte_cnn.Weights(rng.normal(0, 0.5, (256, 7)).astype(np.float32), rng.normal(0, 0.15, (86, 32)).astype(np.float32), rng.normal(0, 0.3, 65).astype(np.float32))
    buf, off = text_buffer(pa.array([prose(1, 90), prose(2, 15)]))
    g = byte_cnn.lay_out(buf, off)
    y = np.array([1, 0], np.float32)

    def loss():
        p = byte_cnn.sigmoid(byte_cnn.pooled(byte_cnn.block_maxima(w, g), g.block_off) @ w.top[:-1] + w.top[-1])
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    grads = byte_cnn._gradient(w, g, y)
    for param, grad in ((w.filters, grads[1]), (w.embedding, grads[0])):
        i = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        param[i] += 1e-2
        up = loss()
        param[i] -= 2e-2
        down = loss()
        param[i] += 1e-2
        assert abs((up - down) / 2e-2 - grad[i]) < 0.15 * abs(grad[i]) + 1e-4


def test_classifier_odd_tables(spark, weights, odd_docs, no_docs):
    got = byte_cnn.quality_scores(odd_docs, weights).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got) and not any(r.held_out for r in got if r.doc_id is None)
    assert byte_cnn.quality_scores(no_docs, weights).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, quality int")
    assert byte_cnn.train_quality(odd_docs, labels).constant
    assert byte_cnn.train_quality(odd_docs, labels.limit(0)).share == 0.5


# --- 2 personal data -------------------------------------------------------------------------------


def brute_base(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.ORDER.index(s[0])))


@pytest.fixture(scope="module")
def crf_model():
    return pii.train()


def test_base_spans_equal_the_patterns():
    r = random.Random(1)
    pieces_ = ["a.b", "@", "x-1", ".com", "1.2.3.4", "4111 1111 1111 1111", "4111111111111111", "+1 (555) 555-5555", " ", "é", ".", "-", "256.1.1.1", "@@", "+", "7", "00000000000000", "\n", "1.2.3.4.5", "%+a@b.c.d@e.f"]
    t = ["".join(r.choice(pieces_) for _ in range(r.randint(0, 14))) for _ in range(1500)] + ["9" * 5000, "a" * 3000 + "@", "1." * 2000]
    buf, off = text_buffer(pa.array(t))
    found = [[] for _ in t]
    for row, kind, a, b in pii.base_spans(buf[: off[-1]].tobytes(), buf, off):
        raw = buf[off[row] :]
        found[row].append((kind, len(raw[: a - off[row]].tobytes().decode()), len(raw[: b - off[row]].tobytes().decode())))
    for x, got in zip(t, found):
        assert sorted(got, key=lambda s: (s[1], pii.ORDER.index(s[0]))) == brute_base(x)


def test_viterbi_is_the_best_path_and_bounds_lose_none(monkeypatch):
    """Against all paths of short texts, with weights that make entities likely and with weights that make them rare."""
    import itertools

    monkeypatch.setattr(crf, "LABELS", crf.LABELS[:5])
    for seed, shift in ((2, 0.0), (3, 2.0), (4, 4.0)):
        rng = np.random.default_rng(seed)
        m = crf.LinearChainCRF(np.zeros((1, 5), np.float32), (rng.normal(size=(5, 5)) + crf.LinearChainCRF.allowed()).astype(np.float32))
        off = np.concatenate([[0], np.cumsum([1, 5, 2, 6, 0, 4] * 6)])
        e = rng.normal(size=(off[-1], 5)).astype(np.float32)
        e[:, 0] += shift
        got, open_words = m.decode(e, off), m.possible(e, off)
        assert shift < 4 or open_words.mean() < 0.9
        for a, b in zip(off[:-1], off[1:]):
            if a < b:
                score = lambda p: m.start()[p[0]] + sum(e[a + i, k] for i, k in enumerate(p)) + sum(m.transition[i, j] for i, j in zip(p, p[1:]))
                assert abs(score(got[a:b]) - max(score(p) for p in itertools.product(range(5), repeat=int(b - a)))) < 1e-3


def test_emissions_equal_the_sum_of_features():
    rng = np.random.default_rng(1)
    emission = rng.normal(size=(crf.FEATURES, len(crf.LABELS))).astype(np.float32)
    texts_ = ["call (555) 123-4567 now", "", "é Ünï", "one", "a b c d e f"]
    buf, off = text_buffer(pa.array(texts_))
    from shiftloom.llm._bytes import SPACED, words

    starts, ends, word_off = words(buf, off, SPACED)
    make = crf.Emitter(emission)
    e = make(buf, starts, ends, word_off)
    names = [make.signatures.names[i] for i in make.signatures.of(buf, starts, ends)]
    for a, b in zip(word_off[:-1], word_off[1:]):
        for i in range(a, b):
            want = sum(emission[crf.role_ids(names[i + d], d, c)].sum(axis=0) if a <= i + d < b else (emission[crf._feature(f"{d}edge")]) for d, c in crf.ROLES)
            assert np.allclose(e[i], want, atol=1e-4)


def spans_of(labels):
    return {(i, next((j for j in range(i + 1, len(labels)) if labels[j] != "I-" + labels[i][2:]), len(labels)), labels[i][2:]) for i in range(len(labels)) if labels[i][0] == "B"}


def test_crf_finds_held_out_kinds(crf_model):
    make, caught, wanted, wrong = crf.Emitter(crf_model.emission), Counter(), Counter(), 0
    table = crf.labelled_table(held_out=True, copies=2)
    for tokens_, labels in table:
        data = [t.encode() for t in tokens_]
        ends = np.cumsum([len(t) for t in data])
        off = np.array([0, len(data)])
        got = spans_of([crf.LABELS[k] for k in crf_model.decode(make(crf._pad(b"".join(data)), ends - [len(t) for t in data], ends, off), off)])
        want = spans_of(labels)
        for s in want:
            wanted[s[2]] += 1
            caught[s[2]] += s in got
        wrong += len(got - want)
    for kind, least in (("email", 0.8), ("phone", 0.75), ("id", 0.8), ("secret", 0.85), ("birth", 0.8)):
        assert caught[kind] >= least * wanted[kind], (kind, caught, wanted)
    assert wrong <= 0.08 * len(table)


def test_crf_reads_every_word(crf_model):
    t = "some plain words and then secret token = " + "deadbeef" * 4 + " . password : hunter22 now and iban : DE44 5001 0517 5407 3249 31 ok"
    buf, off = text_buffer(pa.array([t, "the the the the to to of and " * 40]))
    _, every = pii.find_spans(crf_model, crf.Emitter(crf_model.emission), buf, off)
    found = {(k, t.encode()[a:b].decode()) for k, a, b in every[0]}
    assert {("secret", "deadbeef" * 4), ("secret", "hunter22")} <= found and any(k == "id" for k, _ in found) and not any(k == "email" for k, _ in found)
    assert every[1] == []


def test_pii_odd_rows(spark, odd_docs, no_docs, crf_model):
    got = {(r.doc_id, r.n_phone, r.spans) for r in pii.personal_data(odd_docs, model=crf_model).collect()}
    assert (9, 1, "phone:13:30") in got and (4, 0, "") in got
    assert pii.personal_data(no_docs, model=crf_model).count() == 0
    masked = pii.mask(spark.createDataFrame([(1, "mail é a@b.co now", 17), (2, None, 0)], "doc_id long, text string, n_chars long"), model=crf_model).collect()
    assert masked[0].text == "mail é <EMAIL> now" and masked[0].n_chars == 18 and masked[1].text is None


# --- 4 quality rules and 8 decontamination against their SQL ---------------------------------------


def rows_of(sql, columns, **tables):
    con = duckdb.connect()
    for name, arrow in tables.items():
        con.register(name, arrow)
    r = con.execute(sql)
    names = [c[0] for c in r.description]
    return sorted(tuple(str(x[names.index(c)]) for c in columns) for x in r.fetchall())


def test_quality_rules_equal_sql_on_odd_rows(odd_docs, no_docs):
    got = quality_rules.quality_rules(odd_docs).withColumn("clean_sha256", F.sha2("text", 256))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_lines", "removed_chars", "clean_sha256", "kept"]
    documents = odd_docs.select("doc_id", "text", "source").toArrow()  # noqa: F841 (read by name)
    want = duckdb.sql(OP4_SQL).select(*columns).fetchall()
    assert sorted(map(repr, want)) == sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect())))
    assert quality_rules.quality_rules(no_docs).count() == 0


def test_boilerplate_is_taken_out_at_any_size(spark):
    line = "All rights reserved, visit our front page for more of this"
    for n in (8, 120):
        rows = [(0, f"{line}\nshort tail", "h")] + [(i, f"{prose(i, 60)}\n {line.upper()}  \n\nend {i}", "h" if i <= n // 4 else "other") for i in range(1, n)]
        rows += [(1, rows[1][1], "h")] * 3  # a repeated id is one document
        got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
        assert not got[0].kept and got[0].depleted and got[0].text == "short tail"
        assert got[1].kept and got[1].removed_chars == len(line) and got[1].text == f"{prose(1, 60)}\n\nend 1" and got[1].removed_lines == 1
    one = [(1, f"{prose(1, 60)}\n{line}", "h")] * 40 + [(i, prose(i, 60), "h") for i in range(2, 9)]
    assert all(r.removed_lines == 0 and r.kept for r in quality_rules.quality_rules(spark.createDataFrame(one, "doc_id long, text string, source string")).collect())


def test_fm_index_counts_and_locates():
    r = np.random.default_rng(3)
    s = np.concatenate([np.concatenate([r.integers(1, 6, n), [0]]) for n in (40, 1, 90, 25)])
    index = fm_index.FMIndex(s, 5)
    for size in (1, 2, 4):
        patterns = np.array([s[i : i + size] for i in range(len(s) - size) if 0 not in s[i : i + size]] + [[5] * size])
        low, high = index.search(patterns)
        for p, a, b in zip(patterns, low, high):
            want = [i for i in range(len(s) - size + 1) if (s[i : i + size] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want
    long = np.concatenate([np.tile(r.integers(0, 4, 50), 6), [0]])
    order = fm_index.suffix_order(long)
    gaps = np.flatnonzero(long == 0)
    marks = long + len(gaps)
    marks[gaps] = np.arange(len(gaps))
    assert order.tolist() == sorted(range(len(long)), key=lambda i: marks[i:].tolist())


def test_every_word_of_a_shard_is_indexed():
    w = decontaminate.build_windows(pa.table({"item_id": ["1"], "text": ["b c d"]}), 10)
    buf, off = text_buffer(pa.array(["a b c d e b", "", "c d"]))
    h, _, _, word_off = decontaminate.word_hashes(buf, off)
    symbols, word = decontaminate.shard_symbols(h, word_off, w)
    assert len(symbols) == 8 + 3 and (word >= 0).sum() == 8 and (symbols > 0).sum() == 6 and symbols[-1] == 0


def benchmark_case(spark, odd_docs):
    items = [(1, prose(1, 30)), (2, prose(6, 80)), (10, "lo mi"), (3, None), (None, prose(9, 20)), (1, prose(7, 30)), (4, "...")]
    items = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, key string")
    docs = odd_docs.unionByName(odd_docs.limit(3).withColumn("text", F.concat(F.lit(prose(70, 20) + " "), F.lit(prose(6, 45)), F.lit(" LO, mi "))).withColumn("doc_id", F.lit(77).cast("long")))
    return docs, items


def test_decontamination_equals_sql(spark, odd_docs, no_docs):
    docs, items = benchmark_case(spark, odd_docs)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"]
    got = decontaminate.contamination(docs, items)
    got = got.select(F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    want = rows_of(OP8_SQL, columns, documents=docs.select("doc_id", "text").toArrow(), benchmark=items.select("item_id", "text").toArrow())
    assert sorted(tuple(str(r[c]) for c in columns) for r in got.collect()) == want
    blocks = decontaminate.contamination(docs, items, block_bytes=200)
    blocks = blocks.select(F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    assert sorted(tuple(str(r[c]) for c in columns) for r in blocks.collect()) == want
    assert decontaminate.contamination(no_docs, items).count() == 0
    assert not any(r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect())


def test_cut_spans_removes_hits_only(spark, odd_docs):
    docs, items = benchmark_case(spark, odd_docs)
    before = decontaminate.contamination(docs, items)
    clean = decontaminate.cut_spans(docs, items)
    assert clean.count() == docs.count()
    assert sum(r.n_hit for r in before.collect()) > 0 and not any(r.n_hit for r in decontaminate.contamination(clean, items).collect())
    assert all(r.n_chars == len(r.text) for r in clean.where("doc_id = 77").collect())


# --- 7 and 10 pieces -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel.load(tokens.MODEL)


def test_encoding_equals_the_library(model):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL)
    r = random.Random(3)
    alphabet = "abcdeéß中梦 \t\n .,Th1290ing  😀龘"
    t = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(800)] + [" " * k + "x" for k in range(40)] + ["a" * k for k in range(1, 80, 7)] + ["internationalization" * 9, "", " ", None] + [prose(i, 50) for i in range(40)]
    buf, off = text_buffer(pa.array(t))
    e = pieces.Encoder(model)
    ids, row_off = e.encode(buf, off)
    assert [ids[a:b].tolist() for a, b in zip(row_off, row_off[1:])] == [lib.encode(x or "") for x in t]
    back, back_off = e.decode(ids, row_off)
    assert back_off.tolist() == off.tolist() and back.tobytes() == buf[: off[-1]].tobytes()
    small = pieces.Encoder(model, keep=50)
    assert small.encode(buf, off)[0].tolist() == ids.tolist() == small.encode(buf, off)[0].tolist()


def test_long_units_and_blanks_equal_the_library(model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL)
    r = random.Random(5)
    texts_ = ["a" * 5000, "".join(r.choice("abcdeé中 ") for _ in range(3000)), "x" * 60 + "y" * 60, " " * 70 + "hello", "   ", "ing" * 400, "中文" * 200] + ["".join(r.choice("thein") for _ in range(60)) for _ in range(40)] + [" " * k + "the" + " " * k for k in range(40)]
    encoder = pieces.Encoder(model)
    buf, off = text_buffer(pa.array(texts_))
    ids, row_off = encoder.encode(buf, off)
    assert [ids[a:b].tolist() for a, b in zip(row_off[:-1], row_off[1:])] == [sp.encode(t) for t in texts_]


def test_unigram_paths_have_the_best_score(monkeypatch):
    r = random.Random(9)
    words_ = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 4))) for _ in range(60)} | {"▁", "▁a", "▁ab"})
    scores = np.array([-r.uniform(1, 9) for _ in words_])
    m = pieces.PieceModel.build(words_, scores, np.zeros(len(words_), np.int8), np.arange(256), pieces.UNIGRAM)
    for few in (0, 10**9):
        monkeypatch.setattr(pieces, "LONG", 0)
        monkeypatch.setattr(pieces, "FEW", few)
        for _ in range(60):
            u = "▁" * r.randint(0, 2) + "".join(r.choice("abcd") for _ in range(r.randint(1, 12)))
            best = [0.0] + [-1e9] * len(u)
            for j in range(1, len(u) + 1):
                best[j] = max([best[j - 1] + m.lost] + [best[i] + scores[words_.index(u[i:j])] for i in range(j) if u[i:j] in words_])
            codes = np.array([ord(c) for c in u], np.uint32)
            got = m.one_long(codes) if few else m.viterbi(codes[None])[0]
            assert abs(sum(scores[i] if i >= 0 else m.lost for i in got) - best[-1]) < 1e-6
    proto = open(tokens.MODEL, "rb").read()
    assert pieces.model_type(proto) == pieces.BPE and pieces.model_type(b"") == pieces.UNIGRAM


def test_token_columns_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    back = sorted((str(r.doc_id), r.text) for r in tokens.decode_tokens(tokens.encode_texts(odd_docs)).collect())
    assert back == sorted((str(r.doc_id), r.text or "") for r in rows)
    assert all(r.round_trip for r in tokens.token_digests(odd_docs).collect()) and tokens.token_digests(no_docs).count() == 0


def test_section_counts_are_those_of_the_fields(spark, odd_docs, no_docs):
    counts = Counter()
    for r in tokens.section_tokens(odd_docs, ("source", "lang", "text")).collect():
        counts[r.field] += r.n_tokens
    for field in ("source", "lang", "text"):
        assert counts[field] == sum(r.n_tokens for r in tokens.token_digests(odd_docs, text=field).collect())
    one = tokens.section_tokens(spark.createDataFrame([(5, "hello wor", None, "ld is\nhere")], "doc_id long, a string, b string, c string"), ("a", "b", "c")).collect()
    alone = [len(x) for x in ("hello wor", "", "ld is\n", "here")]
    assert [(r.field, r.section, r.n_chars) for r in one] == [("a", 0, alone[0]), ("b", 0, 0), ("c", 0, alone[2]), ("c", 1, alone[3])] and one[1].n_tokens == 0
    assert tokens.section_tokens(no_docs).count() == 0


def test_attribution_equals_brute_force():
    r = random.Random(6)
    for _ in range(200):
        ends = sorted(r.choices(range(0, 30), k=r.randint(1, 5)))
        n, spans, at = ends[-1], [], 0
        while at < n:
            to = min(n, at + r.randint(0, 5))
            spans.append((at, to))
            at = to
        s, e = np.array([x for x, _ in spans], np.int64), np.array([x for _, x in spans], np.int64)
        got, _ = tokens.attribute(s, e, np.array([0, len(spans)]), np.array(ends), np.array([0, len(ends)]))
        for k, (a, b) in enumerate(spans):
            if b > a:
                held = [max(0, min(b, y) - max(a, x)) for x, y in zip([0, *ends], ends)]
                assert got[k] == held.index(max(held))


# --- 9 language model ------------------------------------------------------------------------------


def test_base_score_equals_brute_force_and_model_beats_it(spark, odd_docs, no_docs):
    r = random.Random(8)
    starts = {"de": ["der", "die", "und", "ein"], "en": ["the", "of", "and", "is"]}
    rows = [(i, " ".join(r.choice(starts[("de", "en")[i % 2]]) for _ in range(60)) + " " + prose(i, 10)) for i in range(200)] + [(None, None), (300, ""), (3, "The THE")]
    got = suffix_tree_lm.language_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fold = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    toks = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)) + [None] for _, t in rows]
    c = Counter(w for (d, _), t in zip(rows, toks) if not fold(d) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), fold(d), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for (d, _), t in zip(rows, toks))
    assert sorted((str(x.doc_id), x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6)) for x in got) == want
    held = [x for x in got if x.held_out]
    assert sum(x.score for x in held) > sum(x.base_score for x in held)
    assert len(suffix_tree_lm.language_scores(odd_docs).collect()) == odd_docs.count()
    assert suffix_tree_lm.language_scores(no_docs).count() == 0


def brute_scores(rows, fold, p_hot, prior, gain, numbered):
    """The model spelt out on dictionaries: every context of every token, its test, its smoothing."""
    from collections import defaultdict

    third = lambda w: int(suffix_tree_lm.tokens(*text_buffer(pa.array([w])))[0][0] >> np.uint64(56)) if w else 11 >> 56
    toks = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)) + ["</end>"] for _, t in rows]
    train = [t for (d, _), t in zip(rows, toks) if not fold(d)]
    c = Counter(w for t in train for w in t)
    n, bar = sum(c.values()), math.log2(max(sum(c.values()), 2))
    hot = {w for w in c if c[w] >= p_hot * n} | {"</end>"}
    cls = lambda w: w if w in hot else None
    rest = sum(c[w] + 1 for w in c if w not in hot) + 1
    base = {x: c[x] + 1 for x in hot} | {None: sum(c[w] for w in c if w not in hot) + 1}
    root = {x: k / sum(base.values()) for x, k in base.items()}
    numbers = {w for w in c if c[w] * numbered >= n} | {"</end>"}
    written = [c[w] for w in c if w not in numbers]

    def share(w):
        return (c[w] + 1) / rest if w in numbers else (sum(written) + len(written) + 1) / (len(written) + 1) / rest

    upper, pairs = {(): root}, set()
    for d in (1, 2):
        counts = defaultdict(Counter)
        for t in train:
            for i in range(d, len(t)):
                counts[tuple(cls(w) for w in t[i - d : i])][cls(t[i])] += 1
        if d == 1:
            pairs = {(w2, w1) for (w2,), k in counts.items() for w1, m in k.items() if w2 and w1 and m >= p_hot * n}
        for ctx, k in counts.items():
            total = sum(k.values())
            up = upper.get(ctx[1:], root)
            if total >= p_hot * n and total * sum(m / total * math.log2(m / total / up[x]) for x, m in k.items()) >= gain * total + bar:
                upper[ctx] = {x: (k[x] + prior * len(k) * up[x]) / (total + prior * len(k)) for x in root}
    records = []
    for row, t in enumerate(toks):
        for i in range(1, len(t)):
            w1, w2, w3 = t[i - 1], t[i - 2] if i > 1 else "<b>", t[i - 3] if i > 2 else None
            level = 1 if cls(w1) is None else 3 if i > 1 and (cls(w2), w1) in pairs else 2
            state = upper.get((cls(w1),), root)
            if level >= 2 and i > 1:
                state = upper.get((cls(w2), cls(w1)), state)
            p = state[cls(t[i])] * (1 if cls(t[i]) else share(t[i]))
            contexts = {1: (w1,), 2: (w1, w2), 3: (w1, w2, third(w3)) if i > 1 else None}
            records.append([row, t[i], p, {d: x for d, x in contexts.items() if d >= level and x}])
    for d in (1, 2, 3):
        counts = defaultdict(Counter)
        for row, w, _, ctx in records:
            if d in ctx and not fold(rows[row][0]):
                counts[ctx[d]][w] += 1
        ps = {(ctx[d], w): p for _, w, p, ctx in records if d in ctx}
        kept = {x for x, k in counts.items() if (m := sum(k.values())) and sum(v * math.log2(v / m / ps[x, w]) for w, v in k.items()) >= gain * m + bar}
        for r in records:
            if d in r[3] and r[3][d] in kept:
                k = counts[r[3][d]]
                r[2] = (k[r[1]] + prior * len(k) * r[2]) / (sum(k.values()) + prior * len(k))
    out = [math.log10(root[cls(t[0])] * (1 if cls(t[0]) else share(t[0]))) for t in toks]
    for row, _, p, _ in records:
        out[row] += math.log10(p)
    return out


@pytest.mark.parametrize(("p_hot", "numbered"), [(0.02, 62_500), (0.05, 300), (0.6, 40)])
def test_scores_equal_brute_force(spark, p_hot, numbered):
    r = random.Random(3)
    common = ["the", "of", "and", "to"]
    rows = [(i, " ".join(r.choice(common) if r.random() < 0.45 else w for w in prose(i % 25, 40).split())) for i in range(60)] + [(100 + i, prose(i // 2, 50)) for i in range(20)] + [(200, None), (201, "new words here"), (None, "the of")]
    fold = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((str(x.doc_id), round(x.score, 4)) for x in suffix_tree_lm.language_scores(df, p_hot=p_hot, prior=2.5, numbered=numbered).collect())
    want = sorted((str(d), round(v, 4)) for (d, _), v in zip(rows, brute_scores(rows, fold, p_hot, 2.5, 0.0, numbered)))
    assert [k for k, _ in got] == [k for k, _ in want] and max(abs(a - b) for (_, a), (_, b) in zip(got, want)) < 1e-3
