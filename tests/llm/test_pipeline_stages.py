"""The stages of the corpus pipeline, each on its own: edge cases, and what each keeps against plain Python."""

import re

import pytest

p = pytest.importorskip("corpus_pipeline")
from lakegrid.llm import op3_token_store as o3  # noqa: E402
from lakegrid.llm.shared import read  # noqa: E402

SF = "/root/testdata/sf0.001"
STAGES = dict(p.STAGES)
LONG = " ".join(f"word{k % 7919}x{k}" for k in range(40_000))
EDGE = [(1, None), (2, ""), (3, "  \n"), (4, "one two three"), (4, "one two three"), (5, LONG), (6, "spam " * 500), (None, "some text without an id that is long enough to be judged by its words alone here"), (None, None), (7, "é 日本 👍 <|endoftext|> x\x00y"), (8, LONG + " end")]
KIND = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, label long, name string, high long, rate double"


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, None if k % 2 else "en", None if k % 3 else "web", None if k % 5 else 1, None, 7, "clash", None, 0.5) for k, (i, t) in enumerate(EDGE)]
    return spark.createDataFrame(rows, KIND)


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, SF, "documents").limit(200).select("doc_id", "text", "lang", "source", "n_chars")


@pytest.mark.parametrize("name", [n for n, _ in p.STAGES[:4]])
def test_stage_edges(spark, edge, name):
    """Nulls in any column, empty and long texts, repeated rows, clashing columns, an empty table."""
    out = STAGES[name](spark, edge, SF)
    assert out.columns == edge.columns
    rows = [tuple(r) for r in out.collect()]
    given = [tuple(r) for r in edge.collect()]
    assert all(rows.count(r) <= given.count(r) for r in rows)
    assert STAGES[name](spark, edge.limit(0), SF).collect() == []
    ids = [r[0] for r in rows]
    if name == "quality rules":
        assert 5 in ids and 8 in ids and not {1, 2, 3, 4, 6, None} & set(ids)
    if name == "near duplicates":
        assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 7]  # 8 goes with 5, 4 stays once
    if name == "decontamination":
        assert len(rows) == len(given)


def test_token_ids_edges(spark, edge):
    got = STAGES["token ids"](spark, edge, SF)
    assert {"doc_id", "start", "n_tokens", "ids_crc32"} <= set(got.columns)
    rows = got.collect()
    assert len(rows) == len(EDGE) and sum(r.n_tokens == 1 for r in rows if r.doc_id in (1, 2)) == 2
    assert STAGES["token ids"](spark, edge.limit(0), SF).collect() == []


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_near_duplicates_keep_the_first_of_each_class(spark, docs):
    """Against all pairs of 5-word sets."""
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []) for i, w in ((i, words(t)) for i, t in texts.items())}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    assert sorted(r.doc_id for r in STAGES["near duplicates"](spark, docs, SF).collect()) == sorted({root(i) for i in sets})


def test_decontamination_drops_planted_passages_only(spark, docs):
    items = [r.text for r in read(spark, SF, "benchmark").orderBy("item_id").limit(6).collect()]
    clean = STAGES["decontamination"](spark, docs, SF).select("doc_id", "text", "lang", "source", "n_chars")
    planted = [(10_000 + k, f"here it begins and {t} so it ends", "en", "s", 1) for k, t in enumerate(items)]
    both = clean.union(spark.createDataFrame(planted, clean.schema))
    kept = {r.doc_id for r in STAGES["decontamination"](spark, both, SF).collect()}
    assert kept == {r.doc_id for r in clean.collect()}


def test_quality_stage_is_the_operator(spark, docs):
    from lakegrid.llm.op6_quality import quality

    kept = {r.doc_id for r in quality(docs).filter("kept").collect()}
    assert {r.doc_id for r in STAGES["quality rules"](spark, docs, SF).collect()} == kept and 0 < len(kept) < 200


def test_mixing_keeps_clean_documents_and_lowers_others(spark):
    docs = read(spark, SF, "documents")
    kept = {r.doc_id for r in STAGES["mixing"](spark, docs, SF).collect()}
    labels = {r.doc_id: (r.quality, r.toxic) for r in read(spark, SF, "labels").collect()}
    share = lambda want: [i in kept for i, x in labels.items() if x == want]
    good, toxic = share((1, 0)), [i in kept for i, x in labels.items() if x[1] == 1]
    assert sum(good) >= 0.95 * len(good)
    assert not toxic or sum(toxic) / len(toxic) <= sum(good) / len(good)


def test_token_ids_are_the_library_s(spark, docs):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, {}
    for r in docs.orderBy("doc_id").collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + [0]
        want[r.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in STAGES["token ids"](spark, docs, SF).collect()} == want


def test_whole_pipeline_is_its_stages(spark):
    """run() gives what the stages give one after the other."""
    docs = read(spark, SF, "documents")
    for _, stage in p.STAGES[:4]:
        docs = o3.written(stage(spark, docs, SF))
    last = p.STAGES[4][1](spark, docs, SF)
    assert sorted(map(tuple, p.run(spark, SF).collect())) == sorted(map(tuple, last.collect()))
