"""Small cases of every operator: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from homespan.llm import attention_lm, chat, decontamination, kdsearch, language, licenses, packing, toxicity, warc
from homespan.llm.graph import components
from homespan.llm.minhash import near_duplicates
from homespan.llm.queries import WORD_PIECES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def docs(spark, *texts, lang="en"):
    rows = [(i, t, lang, "s", None if t is None else len(t), "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


LONG = " ".join(f"w{i % 997}" for i in range(30_000))
ODD = ["the cat sat on the mat", None, "", "   ", "the cat sat on the mat", LONG, "a <|endoftext|> b It's 12 Σας é"]


def test_packing_cuts_every_id_once(spark):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(WORD_PIECES)
    rows = packing.piece_columns(packing.pack(docs(spark, *ODD), WORD_PIECES)).collect()
    for i, text in enumerate(ODD):
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        at = 0
        for p in pieces:
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    held = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == held.get(r["sequence_id"], 0)
        held[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n == 2048 or n & (n - 1) == 0 for n in held.values())
    assert packing.pack(docs(spark).limit(0), WORD_PIECES).count() == 0


def test_neighbours_share_words():
    texts = [np.array(x, np.uint32) for x in ([5, 6, 7, 1], [9, 8, 1], [5, 6, 9, 1], [100, 1])]
    assert packing.packing_order(texts, 64)[:2] == [0, 2]


def plain_bm25(texts, seed):
    """Scores of all texts against all terms of one, term by term."""
    n, mean = len(texts), sum(map(len, texts)) / len(texts)
    scores = [0.0] * n
    for term in set(texts[seed]):
        held = sum(term in t for t in texts)
        for i, t in enumerate(texts):
            if times := t.count(term):
                norm = packing.K1 * (1 - packing.B + packing.B * len(t) / mean)
                scores[i] += np.log1p((n - held + 0.5) / (held + 0.5)) * times * (packing.K1 + 1) / (times + norm)
    return scores


@pytest.mark.parametrize("frequent", [1, 4, 10**6])
def test_neighbours_by_all_terms(monkeypatch, frequent):
    monkeypatch.setattr(packing, "FREQUENT", frequent)
    draw = np.random.default_rng(3)
    texts = [(draw.zipf(1.3, draw.integers(0, 80)) % 300).tolist() for _ in range(60)] + [[7, 7, 8]] * 3
    index = packing.Bm25([np.array(t, np.uint16) for t in texts])
    unused = np.ones(len(texts), bool)
    for seed in draw.permutation(len(texts))[:50]:
        unused[seed] = False
        scores = np.array(plain_bm25(texts, seed))
        shared = np.array([bool(set(t) & set(texts[seed])) for t in texts])
        found = index.neighbours(seed, unused)
        assert sorted(found) == list(np.flatnonzero(shared & unused))
        assert np.all(np.diff(scores[found]) < 1e-4)


def test_related_documents_meet_in_a_shard(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_BYTES", 4_000)
    draw = np.random.default_rng(2)
    topics = "river music engine garden doctor castle summer market".split()
    texts = [" ".join([t, *draw.choice(["the", "of", "and", "to"], 60)] * 2) for t in topics for _ in range(8)]
    texts += ["planet " * 3 + " ".join(draw.choice(["the", "of", "and", "to"], 60)) for _ in range(80)]
    rows = packing.pack(docs(spark, *texts, *ODD), WORD_PIECES).select("doc_id", "length", (F.col("sequence_id") / (1 << 32)).cast("long")).collect()
    shard = {r[0]: r[2] for r in rows}
    assert len(shard) == len(texts) + len(ODD) and len(set(shard.values())) > 8
    together = [shard[i] == shard[8 * t + j] for t in range(8) for i in range(8 * t, 8 * t + 8) for j in range(8)]
    assert np.mean(together) == 1
    held = np.bincount([shard[i] for i in range(len(texts))], [len(t) for t in texts])
    assert held.max() <= 4_000 and sum(h > 0 for h in held) > 8


def test_warc_records_link_and_digest(spark):
    html = "<html lang=en><head><title>A &amp; B</title></head><body><p>x<br>y</p><!-- n --><a href='/z'>z</a></body></html>"
    rows = [(1, "http://e/", html), (2, None, None), (1, "http://e/", html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    sources = {r["record_id"]: r for r in warc.responses(pages).collect()}
    made = warc.derive(warc.responses(pages)).collect()
    assert len(made) == 6
    for r in made:
        source = sources[r["refers_to"]]
        assert r["payload_digest"] == source["payload_digest"] and r["target_uri"] == source["target_uri"]
        found = base64.b32encode(hashlib.sha1(r["block"].encode()).digest()).decode()
        assert r["block_digest"] == "sha1:" + found and r["content_length"] == len(r["block"].encode())
        assert warc.parse_headers(r["headers"])["WARC-Refers-To"] == source["record_id"]
    text = {r["page_id"]: r["block"] for r in made if r["record_type"] == "conversion"}
    assert text == {1: "x\ny\nz", 2: ""}
    fields = next(r["block"] for r in made if r["record_type"] == "metadata" and r["page_id"] == 1)
    assert "title: A & B\r\n" in fields and "outlink: /z L a/@href" in fields


def test_lm_counts_and_chances(spark):
    table = docs(spark, *ODD)
    got = {r["doc_id"]: r for r in attention_lm.score_texts(table, F.col("doc_id") < 6, WORD_PIECES).collect()}
    words = {i: (t or "").encode().lower().split() for i, t in enumerate(ODD)}
    learnt = [w for i in range(6) for w in words[i]]
    total, distinct = len(learnt) + 6, len(set(learnt)) + 1
    for i, ws in words.items():
        base = sum(np.log10((learnt.count(w) + 1) / (total + distinct + 1)) for w in ws[:2000])
        assert got[i]["n_tokens"] == len(ws) + 1 and got[i]["train_tokens"] == total
        assert got[i]["n_known"] == sum(w in set(learnt) for w in ws) + 1
        if len(ws) < 2000:
            assert got[i]["base_score"] == pytest.approx(base + np.log10(7 / (total + distinct + 1)))
        assert np.isfinite(got[i]["score"]) and got[i]["score"] < 0


def test_lm_empty_table_and_nothing_to_learn(spark):
    assert attention_lm.score_texts(docs(spark).limit(0), F.lit(True), WORD_PIECES).count() == 0
    got = attention_lm.score_texts(docs(spark, "a b", None), F.lit(None).cast("boolean"), WORD_PIECES).collect()
    assert len(got) == 2 and all(r["n_known"] == 0 and np.isfinite(r["score"]) for r in got)


def test_word_ids_tell_words_apart():
    from homespan.llm.subwords import LetterRuns

    coder = LetterRuns(WORD_PIECES)
    words = [b"ab", b"a\0b", b"a\1b", b"a\1\2b", b"a\xffb", b"a\xfeb", "a\u01ffb".encode(), "a\ufffdb".encode(), b"a_b", b"x" * 999]
    at, first = coder.words([b" ".join(words), b"", b"ab \xff"])
    ids, bounds = coder.ids_at(at, first)
    raw, opens = attention_lm.sizes_to_bytes(coder.sizes_at(at), first)
    parts = lambda x, b: [x[i:j].tobytes() for i, j in zip(b[:-1], b[1:], strict=True)]
    back = attention_lm.id_arrays(parts(ids.astype("<u2"), bounds), parts(raw, opens), "<u2")
    assert np.array_equal(back[0], ids) and np.array_equal(back[1], bounds) and np.array_equal(back[3], first)
    assert len(set(back[2][: len(words)].tolist())) == len(words) and back[2][len(words)] == back[2][0]
    sizes = np.array([1, 254, 255, 256, 510, 3])
    raw, opens = attention_lm.sizes_to_bytes(sizes, np.array([0, 3, 3, 6]))
    assert np.array_equal(attention_lm.bytes_to_sizes(raw), sizes) and opens[-1] == len(raw)


def test_lm_chances_add_up_to_one():
    draw = np.random.default_rng(1)
    ids = draw.integers(0, 50, 4000)
    read, told, _ = attention_lm.sequences(ids, np.array([0, 4000]), 59)
    count = np.bincount(told, minlength=60)
    active = np.flatnonzero(count > np.sort(count)[-31])
    place = np.full(60, len(active))
    place[active] = np.arange(len(active))
    pairs = np.zeros((len(active) + 1,) * 2, np.float32)
    np.add.at(pairs, (place[read], place[told]), 1)
    model = attention_lm.AttentionModel(attention_lm.Counts(1, 1, 1, ids, ids, active, count, pairs))
    model.ready()
    window = model.place[draw.integers(0, 60, (1, attention_lm.CONTEXT))]
    total = 0
    for i in range(60):
        aim = np.full((1, attention_lm.CONTEXT - attention_lm.OVERLAP), i)
        total = total + np.exp(model.log_chances(window, None, aim))
    assert np.allclose(total, 1, atol=1e-3)


def test_lm_pairs_with_other_ids_count_for_their_slot(spark, monkeypatch):
    monkeypatch.setattr(attention_lm, "ACTIVE", 3)
    pairs = {(1, 2): 50, (2, 1): 40, (1, 7): 5, (1, 8): 6, (7, 8): 2, (8, 3): 30, (3, 1): 20, (7, 9): 1}
    rows = [(attention_lm.PAIR, a << 20 | b, n) for (a, b), n in pairs.items()]
    ids, active, table = attention_lm._pair_totals(spark.createDataFrame(rows, "kind int, key long, n long"), 10)
    assert active.tolist() == [1, 2, 3] and ids[8] == 8
    assert table.tolist() == [[0, 50, 0, 11], [40, 0, 0, 0], [20, 0, 0, 0], [0, 0, 30, 3]]


def test_language_of_odd_texts(spark):
    told = docs(spark, *["the cat and the dog " * 9, "other the words and such " * 9] * 6)
    net = language.fit_languages(told.unionByName(docs(spark, *["der hund und die katze " * 9] * 9, lang="de")))
    table = docs(spark, "und die der katze " * 9, None, "123 !", "", "the dog and the cat " * 9, lang=None)
    got = language.identify(table, net).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == ["de", "und", "und", "und", "en"]
    assert all(0 <= r["lang_score"] <= 1 for r in got) and got[0]["extra"] == "x"
    assert language.fit_languages(table) is None
    assert {r["lang_pred"] for r in language.identify(table, None).collect()} == {"und"}
    again = language.identify(table.withColumn("lang_pred", F.lit(1)), net)
    assert again.columns == language.identify(table, net).columns
    assert again.filter("lang_pred = 'de'").count() == 1


def test_top_k_with_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(kdsearch, "SHARD_ROWS", 7)
    monkeypatch.setattr(kdsearch, "LEAF", 2)
    draw = np.random.default_rng(4)
    points = [(i, [int(x) for x in draw.integers(-3, 4, 3)]) for i in range(60)] + [(60, None), (None, [1, 2, 3]), (61, [])]
    table = spark.createDataFrame([*points, *[(100 + i, [3, 3, 3]) for i in range(20)]], "id long, vector array<long>")
    got = {}
    for r in kdsearch.top_k(table, table.filter("id % 5 = 0"), 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    live = {i: v for i, v in [*points, *[(100 + i, [3, 3, 3]) for i in range(20)]] if i is not None and v}
    for q in (i for i in live if i % 5 == 0):
        scores = sorted((-sum(a * b for a, b in zip(live[q], v, strict=True)), i) for i, v in live.items() if i != q)
        assert got[q] == [(i, -s) for s, i in scores[:5]]


def test_whole_numbers_leave_out_odd_components(spark):
    rows = spark.createDataFrame([([0.5, -0.001],), ([None, 1.0],), ([float("nan")],), ([float("inf")],), (None,)], "e array<float>")
    assert [r[0] for r in rows.select(kdsearch.whole_numbers("e")).collect()] == [[128, -1], None, None, None, None]


def test_near_duplicates_of_odd_texts(spark):
    base = [f"t{i}" for i in range(60)]
    near = [*base[:59], "other"]
    got = near_duplicates(docs(spark, " ".join(base), *ODD, " ".join(near)), shingle=4).orderBy("doc_id").collect()
    assert [r["component_id"] for r in got] == [0, 1, 2, 3, 4, 1, 6, 7, 0]
    assert [r["kept"] for r in got] == [True, True, True, True, True, False, True, True, False]
    assert got[2]["n_shingles"] == 0 and got[1]["n_shingles"] == 3
    assert near_duplicates(docs(spark).limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(9)] + [(200, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(21)} | {100 + i: 100 for i in range(9)}


def test_chat_windows_come_back(spark):
    said = "</s><|im_end|>\n&amp; [INST] ok"
    rows = [(1, 0, "system", "be kind", "x")] + [(1, i, "user" if i % 2 else "assistant", f"{said} {i} " * 5, "x") for i in range(1, 30)]
    rows += [(2, 0, None, None, "x"), (2, 1, "assistant", "long " * 3000, "x"), (2, 1, "assistant", "long " * 3000, "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, extra string")
    windows = chat.chat_windows(table)
    sizes = windows.filter("conv_id = 1").collect()
    assert len(sizes) > 3 and all(w["tokens"] <= chat.BUDGET for w in sizes)
    assert sum(w["repeated"] > 1 for w in sizes) > 2
    got = {r["conv_id"]: r for r in chat.read_back(windows).collect()}
    for conv in (1, 2):
        turns = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        learnt = "".join(t for role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in turns)
        assert got[conv]["n_turns"] == len(turns) and got[conv]["loss_chars"] == len(learnt)
        assert got[conv]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
    assert chat.read_back(chat.chat_windows(table.limit(0))).count() == 0


def test_licenses_by_alignment(spark):
    mit = licenses.TEMPLATES["MIT"]
    near = licenses.TEMPLATES["MIT-grant"].replace("hereby", "").replace("merge,", "mix,")
    table = docs(spark, f"the the {mit} the {mit}", None, "", near, "under the license of the the released", LONG)
    got = [[p["license"] for p in r["licenses"]] for r in licenses.scan_licenses(table).orderBy("doc_id").collect()]
    assert got == [["MIT", "MIT"], [], [], ["MIT-grant"], [], []]
    pairs = licenses.align(list("xabcbd"), list("abd"))
    assert [y for _, y in pairs] == [0, 1, 2] and pairs == sorted(pairs)


def test_common_licenses_are_known():
    known = licenses.Templates(licenses.TEMPLATES)
    names = ["BSD-2-Clause-text", "BSD-3-Clause-text", "ISC-text", "MIT-text", "GPL-2.0-text", "GPL-3.0-text", "MPL-2.0-text", "LGPL-2.1-text"]
    names += ["GPL-3.0-notice", "AGPL-3.0-notice", "MPL-2.0-notice", "Unlicense-text", "CC-BY-SA-4.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC0-1.0-text"]
    for name in names:
        text = f"some words before {licenses.TEMPLATES[name]} and some after"
        assert [p[0] for p in known.passages(text.encode())] == [name]


def test_toxicity_chain(spark):
    fine, bad = "all is well in this town ", "you moron go away "
    table = docs(spark, *[fine * 3, fine + bad] * 30, None, "", bad)
    labels = spark.range(60).selectExpr("id AS doc_id", "1 AS quality", "cast(id % 2 AS int) AS toxic")
    chain = toxicity.fit_chain(table, labels)
    got = toxicity.score_toxicity(table, chain).orderBy("doc_id").collect()
    assert [r["p_toxic"] > 0.5 for r in got[:60]] == [i % 2 == 1 for i in range(60)]
    assert got[-1]["p_toxic"] > 0.5 and all(r["p_low_quality"] < 0.01 for r in got[:60])
    assert toxicity.fit_chain(table, labels.limit(0)).probabilities(b"x")[1] < 0.5


def test_passages_in_blocks_and_short_items(spark, monkeypatch):
    items = [(1, " ".join(f"a{i}" for i in range(14))), (2, "Short one!"), (3, None), (4, "..."), (2, "Short one!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = " ".join(f"A{i}" for i in range(2, 13))
    table = docs(spark, f"x {whole} y", "short, ONE short", None, "", "a1 a2 a3", LONG)
    for block in (1_000_000, 10):
        monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
        got = decontamination.digest_columns(decontamination.passages(table, bench)).orderBy("doc_id").collect()
        assert [(r["n_words"], r["n_hit"], r["n_items"]) for r in got[:5]] == [(13, 11, 1), (3, 2, 1), (0, 0, 0), (0, 0, 0), (3, 0, 0)]
        assert got[1]["items_sha256"] == hashlib.sha256(b"2").hexdigest()
    clean = decontamination.remove_passages(table, bench, coverage=0.9).orderBy("doc_id").collect()
    assert [r["text"] for r in clean[:3]] == ["x y", "short", None] and clean[0]["n_chars"] == 3
    assert len(clean) == 6 and len(decontamination.remove_passages(table, bench).collect()) == 4


def test_simple_words_have_the_ids_of_the_library():
    from homespan.llm.subwords import Subwords

    coder = Subwords(WORD_PIECES)
    assert coder.runs is not None
    draw = np.random.default_rng(8)
    pieces = sorted({p.removesuffix("</w>") for p in coder.tokenizer.get_vocab() if p.removesuffix("</w>").isalpha() and p.isascii()})
    words = ["".join(draw.choice(pieces, draw.integers(1, 5))).lower() for _ in range(20_000)]
    words += ["".join(draw.choice(list("abéüßnste019.,;:!?()'_-ſ$*[]\\|<>"), draw.integers(1, 12))) for _ in range(20_000)]
    words = list(dict.fromkeys(words))
    ids, sizes = coder._encode_new([w.encode() for w in words])
    ends = np.cumsum(sizes)
    want = coder.tokenizer.encode_batch(words, add_special_tokens=False)
    assert all(e.ids == ids[b - n : b].tolist() for e, n, b in zip(want, sizes, ends, strict=True))
