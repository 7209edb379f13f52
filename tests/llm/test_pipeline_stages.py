"""Every stage of the pipeline against brute force, with odd columns, repeated ids and empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from homespan.llm.minhash import near_duplicates
from tests.conftest import TESTDATA

FOLDER = str(TESTDATA / "sf0.001")
DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, p_toxic double, spans string, "
    "tags map<string,string>"
)


def rows_of(*pairs):
    return [(i, t, "en", "s", 0, "kept", 7.0, "kept", {"k": str(n)}) for n, (i, t) in enumerate(pairs)]


def words(text, size=5):
    told = text.lower().split()
    if len(told) < size:
        return {tuple(told)} if told else set()
    return {tuple(told[i : i + size]) for i in range(len(told) - size + 1)}


def groups(texts):
    """Smallest place of each text's group of near copies."""
    sets = [words(t or "") for t in texts]
    part = list(range(len(texts)))
    find = lambda i: i if part[i] == i else find(part[i])
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                part[y] = x
    return [find(i) for i in range(len(texts))]


def test_near_dedup_keeps_one_text_of_each_group(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    told = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    want = [told[g][0] for i, g in enumerate(groups([t for _, t in told])) if g == i]
    got = pipeline.near_duplicate(spark, docs, FOLDER)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == want and len(want) < len(told)


def test_near_dedup_loses_no_text_of_a_repeated_id(spark):
    long = " ".join(f"a{i}" for i in range(60))
    other = " ".join(f"b{i}" for i in range(60))
    third = " ".join(f"c{i}" for i in range(60))
    rows = rows_of((5, long), (5, other), (5, other), (7, other + " end"), (1, third), (None, third), (None, "alone " + long[9:]),
                   (None, "quite another text of its own"), (9, None), (10, ""), (9, None))
    got = pipeline.near_duplicate(spark, spark.createDataFrame(rows, DOCS), FOLDER).collect()
    found = sorted((str(r["doc_id"]), r["text"]) for r in got)
    assert [t for _, t in found if t].count(third) == 1 and ("1", third) in found
    assert sum(t in (other, other + " end") for _, t in found) == 1
    assert sum(bool(t) and len(words(t) & words(long)) > 40 for _, t in found) == 1
    assert ("None", "quite another text of its own") in found and ("10", "") in found and ("9", None) in found
    assert len(found) == 6
    assert all(r["lang_pred"] == "kept" and r["tags"] for r in got)


def test_ids_of_several_texts_are_one_node(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(1, a), (5, a), (5, b), (7, b), (7, ""), (8, ""), (9, None), (9, "solo word list of six words")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [
        (1, 1, True), (5, 1, False), (5, 1, False), (7, 1, False), (7, 1, False), (8, 8, True), (9, 9, True), (9, 9, True)]


def plain_removal(text, items, window=10, coverage=0.5):
    """Whether the document stays, and which of its words are inside windows of items."""
    cut = lambda t: "".join(c if c.isalnum() and c.isascii() or ord(c) > 127 else " " for c in t.lower()).split()
    told = cut(text or "")
    known = set()
    for item in items:
        w = cut(item)
        known |= {tuple(w[i : i + window]) for i in range(len(w) - window + 1)} or ({tuple(w)} if w else set())
    hit = set()
    for size in {len(k) for k in known}:
        for i in range(len(told) - size + 1):
            if tuple(told[i : i + size]) in known:
                hit |= set(range(i, i + size))
    return not hit or len(hit) <= coverage * len(told), hit


def test_decontamination_removes_what_brute_force_finds(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = {r["doc_id"]: r["text"] for r in pipeline.benchmark_passages(spark, docs, FOLDER).collect()}
    cut = 0
    for r in docs.collect():
        stays, hit = plain_removal(r["text"], items)
        assert (r["doc_id"] in got) == stays
        if stays and hit:
            cut += 1
            assert not plain_removal(got[r["doc_id"]], items)[1]
        elif stays:
            assert got[r["doc_id"]] == r["text"]
    assert cut or len(got) < docs.count()


@pytest.fixture(scope="module")
def run(spark):
    """What each stage returned over the small table with odd columns, beside its input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.withColumns({"lang_pred": F.lit("kept"), "P_TOXIC": F.lit(7.0), "n_words": F.lit("kept"), "tags": F.create_map(F.lit("k"), F.lit("v"))})
    out = []
    for _, stage in pipeline.STAGES:
        told = stage(spark, docs, FOLDER).cache()
        out.append((docs, told))
        docs = told
    return out


def test_filtering_stages_keep_rows_as_they_are(run):
    for (before, after), (name, _) in zip(run[:3], pipeline.STAGES, strict=False):
        assert after.columns == before.columns and 0 < after.count() <= before.count(), name
        assert after.select("doc_id", "text", "lang_pred", "P_TOXIC", "n_words").exceptAll(before.select("doc_id", "text", "lang_pred", "P_TOXIC", "n_words")).isEmpty()
        assert after.filter("tags['k'] = 'v' AND lang_pred = 'kept' AND P_TOXIC = 7 AND n_words = 'kept'").count() == after.count()


def test_toxic_documents_go_and_clean_ones_stay(spark, run):
    before, after = run[1]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic IS NOT NULL").select("doc_id", "toxic").distinct()
    told = before.join(labels, "doc_id").join(after.select("doc_id", F.lit(1).alias("stays")), "doc_id", "left")
    counts = {(r["toxic"], r["stays"]): r["n"] for r in told.groupBy("toxic", "stays").agg(F.count("*").alias("n")).collect()}
    clean = counts.get((0, 1), 0) / max(1, counts.get((0, 1), 0) + counts.get((0, None), 0))
    assert clean >= 0.95


def test_packing_holds_every_id_of_what_was_kept(run):
    from tokenizers import Tokenizer

    before, pieces = run[4]
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {r["doc_id"]: len(coder.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in before.collect()}
    held = {r["doc_id"]: r["n"] for r in pieces.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert held == sizes


def test_empty_documents(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
