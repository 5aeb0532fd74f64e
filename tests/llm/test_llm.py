"""The operators of the llm subpackage against brute force, the libraries, and hand-made edge cases."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("lakegrid.llm")
from lakegrid.llm import op1_language as o1  # noqa: E402
from lakegrid.llm import op2_mixing as o2  # noqa: E402
from lakegrid.llm import op3_token_store as o3  # noqa: E402
from lakegrid.llm import op4_jaccard as o4  # noqa: E402
from lakegrid.llm import op5_ppm as o5  # noqa: E402
from lakegrid.llm import op6_quality as o6  # noqa: E402
from lakegrid.llm import op7_toxicity as o7  # noqa: E402
from lakegrid.llm import op8_token_counts as o8  # noqa: E402
from lakegrid.llm import op9_pii as o9  # noqa: E402
from lakegrid.llm import op10_decontaminate as o10  # noqa: E402
from lakegrid.llm.queries import QUERIES  # noqa: E402
from lakegrid.llm.shared import read, shared_folder  # noqa: E402

SF = "/root/testdata/sf0.001"
EDGE = [(1, None), (2, ""), (3, "   \n\t"), (4, "one two"), (4, "one two"), (None, "one two three four five six"), (6, "word " * 30_000), (7, "ONE two three four five SIX"), (8, "é ñ ü 日本 👍 <|endoftext|> x\x00y"), (9, "one  two\n\nthree\r\n four")]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "en", "s", 1, 5, "clash") for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score long, key string")


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, SF, "documents")


def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def test_language_held_out_accuracy(spark, docs):
    got = {r.doc_id: r for r in o1.identify(docs).collect()}
    true = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in true if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(held) == sorted(i for i in got if got[i].held_out)
    assert sum(got[i].lang_pred == true[i] for i in held) >= 0.95 * len(held)


def test_language_gradients():
    w = {k: a.astype(float) for k, a in o1.start_weights(3).items()}
    rng = np.random.RandomState(0)
    x, inside, y = rng.randint(0, 256, (6, 4)), np.ones((6, 4)), np.array([0, 1, 2, 1])

    def loss():
        p = o1.label(w, o1.states(w, x)[0])
        return -np.log(p[:, y, np.arange(4)]).mean()

    g = o1.gradients(w, x, inside, y)
    for name in w:
        i = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        w[name][i] += 1e-2
        up = loss()
        w[name][i] -= 2e-2
        down = loss()
        w[name][i] += 1e-2
        assert abs((up - down) / 2e-2 - g[name][i]) < 0.05 * abs(g[name][i]) + 1e-4


def test_language_probabilities_are_the_recurrence_s():
    """Pooled probabilities against the recurrence written out byte by byte, window by window, with large weights too."""
    rng = np.random.RandomState(2)
    for scale in (1, 40):
        w = {k: a * scale for k, a in o1.start_weights(3).items()}
        for n in (1, 63, 64, 200):
            t = bytes(rng.randint(0, 256, n).tolist())
            parts = [t[a : a + o1.WINDOW] for a in range(0, n, o1.WINDOW)]
            got = [o1.pooled(w, np.frombuffer(p, np.uint8), np.array([0, len(p)]), 3)[0] for p in parts]
            assert np.isfinite(got).all() and abs(np.sum(got) - n) < 1e-3 * n
            for part, total in zip(parts, got, strict=True):
                both = []
                for d, order in (("f", part), ("b", part[::-1])):
                    h, out = np.zeros(o1.STATE), []
                    for x in order:
                        z = np.tanh(w["A" + d][x] + w["U" + d] @ h)
                        h = h + (z[: o1.STATE] + 1) / 2 * (z[o1.STATE :] - h)
                        out.append(h)
                    both.append(out if d == "f" else out[::-1])
                z = np.array([w["V"] @ np.concatenate(x) + w["c"] for x in zip(*both, strict=True)])
                p = np.exp(z - z.max(1, keepdims=True))
                assert scale > 1 or np.allclose(total, (p / p.sum(1, keepdims=True)).sum(0), rtol=1e-3)


def test_language_edges(edge):
    assert o1.identify(edge.limit(0)).count() == 0
    got = o1.identify(edge).collect()
    assert len(got) == len(EDGE) and all(r.lang_pred in ("en", "und") and 0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in o1.identify(edge.withColumn("lang", o1.F.lit(None).cast("string"))).collect()} == {"und"}


def test_mixing_meets_targets(spark, docs):
    rows = o2.mixed(docs, read(spark, SF, "labels")).collect()
    names = sorted(c[2:] for c in rows[0].asDict() if c.startswith("p_"))
    total = sum(r.n_tokens for r in rows)
    for d in names:
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) / total - o2.TARGETS[d]) < 1e-3
    assert all(0 <= r.rate <= o2.MAX_RATE and abs(sum(r[f"p_{d}"] for d in names) - 1) < 1e-9 for r in rows)


@pytest.mark.parametrize(("share", "most"), [((0.2, 0.5, 0.3), 4.0), ((1.0, 1.0, 1.0), 1.0), ((0.1, 3.0, 0.2), 2.0), ((0.0, 0.4, 0.9), 1.5)])
def test_mixing_fit_is_the_least_squares_optimum(spark, share, most):
    """Goals within reach are met; for others every rate is at a bound that the gradient holds it to, or has no gradient."""
    rng = np.random.RandomState(3)
    p = rng.dirichlet([0.4, 0.4, 0.4], 60)
    t = rng.randint(10, 500, 60)
    df = spark.createDataFrame([(int(n), *map(float, q)) for n, q in zip(t, p, strict=True)], "n_tokens long, p_a double, p_b double, p_c double")
    goal = np.array(share) * t.sum()
    got = o2.fit(df, ["a", "b", "c"], goal, most)
    rows = got.table.collect()
    r, t, p = (np.array([list(x[i:j]) for x in rows]).squeeze() for i, j in ((4, 5), (0, 1), (1, 4)))
    assert got.done and r.min() >= 0 and r.max() <= most and np.allclose((r * t) @ p, got.totals, rtol=1e-9)
    if share == (0.2, 0.5, 0.3):
        assert np.allclose(got.totals, goal, rtol=1e-5) and got.miss < 3e-6
        return
    slope = p @ (got.totals - goal) / np.linalg.norm(goal)
    assert np.linalg.norm(np.where(r == 0, np.minimum(slope, 0), np.where(r == most, np.maximum(slope, 0), slope))) < 0.05 * np.linalg.norm(slope)
    best = r.copy()  # and plain projected gradient over many steps finds nothing better
    for _ in range(50_000):
        best = np.clip(best - (p @ (p.T @ (best * t) - goal)) * t / (np.linalg.norm((p * t[:, None]).T @ (p * t[:, None]), 2)), 0, most)
    assert got.miss <= np.linalg.norm((best * t) @ p - goal) / np.linalg.norm(goal) * 1.01 + 1e-9


def test_mixing_terms(spark):
    """Words without their marks, lower-cased; style marks; words as white space parts them."""
    cases = {1: "Ein Wort, zwei\tWörter!\n\x0bdrei\f4 \r ", 2: "A|B|C", 3: "#1 $$ *", 4: "ABC DEF 12345", 5: "", 6: "¿qué? «où» 中文。字"}
    df = spark.createDataFrame(list(cases.items()), "i int, text string").select("i", o2._terms(o2.F.col("text")).alias("t"), o2._words(o2.F.col("text")).alias("n"))
    got = {r.i: (set(r.t) - {""}, r.n) for r in df.collect()}
    assert {i: n for i, (_, n) in got.items()} == {i: len(words(t)) for i, t in cases.items()}
    assert got[1][0] == {"#short", "ein", "wort", "zwei", "wörter", "drei", "4"} and got[2][0] == {"#short", "#bars", "#capitals", "a", "b", "c"}
    assert got[3][0] == {"#short", "#symbols", "#digits", "1"} and got[4][0] == {"#short", "#capitals", "#digits", "abc", "def", "12345"}
    assert got[6][0] == {"#short", "qué", "où", "中文", "字"}


def test_mixing_scores_are_the_classifier_s(spark):
    """Posteriors from the plan equal those from the weights."""
    rng = np.random.RandomState(0)
    terms = [f"t{i}" for i in range(200)]
    model = o2.Classifier(["a", "b"], terms, np.array([0.3, -0.2]), rng.normal(0, 1, (200, 2)))
    texts_ = [" ".join(rng.choice([*terms, "other"], 30)) for _ in range(20)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    for r in o2.memberships(df, model).collect():
        hit = sorted({terms.index(w) for w in (texts_[r.doc_id] or "").split() if w != "other"})
        z = model.start + model.odds[hit].sum(0)
        assert math.isclose(r.p_a, math.exp(z[0]) / np.exp(z).sum(), rel_tol=1e-9)


def test_mixing_edges(spark, edge):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = o2.mixed(edge, none).collect()
    assert len(rows) == len(EDGE) and all(r.rate == 1.0 and r.p_all == 1.0 for r in rows)
    some = spark.createDataFrame([(4, 1, None), (7, 0, 0), (6, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert len(o2.mixed(edge, some).collect()) == len(EDGE)
    assert o2.mixed(edge.limit(0), some).count() == 0


def test_token_store_is_the_library(spark, docs):
    want, at, lib = [], 0, o3.encoder(o3.public_tokenizers.path(o3.VOCABULARY)).library
    for i, t in sorted(texts(docs).items()):
        ids = lib.encode(t, add_special_tokens=False).ids + [0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op3_token_store"](spark, SF).collect())) == want


def test_token_store_round_trip_and_tampering(spark, edge):
    folder = shared_folder(spark)
    o3.write_store(edge, folder)
    assert o3.verify(spark, folder).count() == 0
    lib = o3.encoder(o3.public_tokenizers.path(o3.VOCABULARY)).library
    want = sorted((i or -1, lib.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in EDGE)
    assert sorted((r.doc_id or -1, list(r.ids)) for r in o3.read_documents(spark, folder).collect()) == want
    chunks = o3._chunks(spark, folder)
    assert chunks.count() == chunks.select("hash").distinct().count()
    recipes, manifest = (spark.read.parquet(f"{folder}/{t}") for t in ("recipes", "manifest"))
    one = o3.F.col("hash") == chunks.first().hash
    cases = [("chunk", chunks.withColumn("ids", o3.F.when(one, o3.F.unhex(o3.F.lit("0100"))).otherwise(o3.F.col("ids"))), recipes, "missing or altered"), ("missing chunk", chunks.filter(~one), recipes, "missing or altered"), ("recipe", chunks, recipes.withColumn("root", o3.F.when(o3.F.col("doc_id") == 9, o3.F.unhex(o3.F.lit("00"))).otherwise(o3.F.col("root"))), "altered recipe of document 9")]
    for problem, c, r, message in cases:
        bad = shared_folder(spark)
        c.withColumnRenamed("hash", "key").withColumn("kind", o3.F.lit("chunk")).write.partitionBy("kind").parquet(f"{bad}/streams")
        r.write.parquet(f"{bad}/recipes")
        manifest.write.parquet(f"{bad}/manifest")
        assert problem in {x.problem for x in o3.verify(spark, bad).collect()} <= {problem, "manifest"}
        with pytest.raises(Exception, match=message):
            o3.read_digests(spark, bad).collect()


def test_token_store_pieces_are_the_library_s():
    """Texts of awkward pieces: contractions at every place, runs of white space, marks, other scripts, special strings."""
    path = o3.public_tokenizers.path(o3.VOCABULARY)
    lib = o3.encoder(path).library
    rng = random.Random(8)
    parts = ["'", "'s", "'re", "'ll", "'d", "it", "S", "42", "7", " ", "  ", "\n", "\t", "\r\n", ",", "...", "--", "$", "é", "ß", "ñu", "×", "÷", "я", "Ѐ", "中", "文字", "²", "½", "\u00a0", "\u0085", "\u3000", "👍", "<|endoftext|>", "<|", "|>", "\x00", "\x1c", "ǅ", "ʰ", "ا", "क"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(6000)]
    plain = ["".join(rng.choice(parts[:23]) for _ in range(rng.randrange(1, 14))) for _ in range(6000)]
    column = pa.array([*texts, None, "", *plain], pa.string())
    encoder = o3.Encoder(path)
    for _ in range(2):  # with pieces new, then known
        ids, at = encoder.encode(column)
        for i, t in enumerate(column.to_pylist()):
            assert ids[at[i] : at[i + 1]].tolist() == [*lib.encode(t or "", add_special_tokens=False).ids, 0], repr(t)
    assert len(encoder.place) > 500
    for n in (1, 3):  # slices of any size
        ids, at = encoder.encode(column.slice(n, 200))
        assert ids[at[0] : at[1]].tolist() == [*lib.encode(texts[n], add_special_tokens=False).ids, 0]
    word = o3.public_tokenizers.path("word_bpe_49k.json")  # another pattern: whole texts
    ids, at = o3.Encoder(word).encode(pa.array(["Two words'll do"]))
    assert ids.tolist() == [*o3.Tokenizer.from_file(word).encode("Two words'll do", add_special_tokens=False).ids, 0]


def test_token_store_order_and_edges(spark, edge):
    """Starts follow ascending doc_id, null first; no documents give no rows."""
    folder = shared_folder(spark)
    o3.write_store(edge, folder)
    rows = sorted((r.start, r.doc_id, r.n_tokens) for r in o3.read_digests(spark, folder).collect())
    assert [r[1] for r in rows] == [None, 1, 2, 3, 4, 4, 6, 7, 8, 9]
    assert [r[0] for r in rows] == np.concatenate(([0], np.cumsum([r[2] for r in rows])[:-1])).tolist()
    none = shared_folder(spark)
    o3.write_store(edge.limit(0), none)
    assert o3.read_digests(spark, none).count() == 0 and o3.verify(spark, none).count() == 0


def test_chunks_and_crc_combination():
    rng = np.random.RandomState(1)
    ids = rng.randint(0, 50_000, 20_000).astype("<u4")
    ends = o3.chunk_ends(o3.cuts(ids, np.array([0, len(ids)])).tolist(), len(ids))
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(ids) and sizes.max() <= o3.MOST and sizes[:-1].min() >= o3.LEAST and 50 < len(ends) < 90
    longer = np.concatenate((ids[:7], ids))
    shifted = o3.chunk_ends(o3.cuts(longer, np.array([0, len(longer)])).tolist(), len(longer))
    assert len({e - 7 for e in shifted} & set(ends)) > 0.8 * len(ends)
    both = o3.cuts(np.concatenate((ids, ids)), np.array([0, len(ids), 2 * len(ids)])).tolist()  # a stream's cuts don't depend on the one before
    assert both == [*o3.cuts(ids, np.array([0, len(ids)])).tolist(), *(o3.cuts(ids, np.array([0, len(ids)])) + len(ids)).tolist()]
    a, b = b"hello" * 9, b"world" * 1000
    got = int(o3._times(np.array([zlib.crc32(a)], np.uint64), o3.shift(np.array([len(b)])))[0]) ^ zlib.crc32(b)
    assert got == zlib.crc32(a + b)


def brute_components(pairs_of):
    sets = {}
    for i, t in pairs_of.items():
        w = words(lower(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (i, len(sets[i]), find(i)) for i in ids}


def test_jaccard_classes(spark, docs):
    got = {r.doc_id: (r.doc_id, r.n_shingles, r.component_id) for r in o4.similarity_classes(docs).collect()}
    assert got == brute_components(texts(docs))


def test_jaccard_near_copies_of_near_copies(spark):
    """Chains and hubs around the threshold, where a pivot does not answer for all."""
    rng = random.Random(5)
    made, base = {}, [f"w{rng.randrange(10**6)}" for _ in range(120)]
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        if rng.random() < 0.3:
            w = w[: rng.randrange(70, 120)]
        made[100 - i] = " ".join(w)
        if rng.random() < 0.2:
            base = w if len(w) == 120 else base
    df = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    for buckets in (1, 7):
        got = {r.doc_id: (r.doc_id, r.n_shingles, r.component_id) for r in o4.similarity_classes(df, buckets).collect()}
        assert got == brute_components(made)


def test_jaccard_open_list_is_no_group(spark):
    """One list of many connected members, two that are not, and a few of another size: block pairs of bounded size hold each pair of different labels once, and few others."""
    rows = [(7, 1000 + i, 100 + i % 3, 100, 5, -1, 100) for i in range(5000)] + [(7, 1, 101, 101, 1, -1, 100), (7, 2, 99, 99, 2, -1, 100)] + [(7, 10 + i, 900, 900, 10 + i, -1, 100) for i in range(20)]
    opened = spark.createDataFrame(rows, "list long, member long, size int, rest int, label long, inter long, pivot_size int")
    dealt = o4.crossed(opened)
    sizes = [r[0] for r in dealt.groupBy("block").count().select("count").collect()]
    assert max(sizes) <= 2 * 1.5 * o4.BLOCK and sum(sizes) < 20_000
    pairs = [(r.a, r.b) for r in dealt.mapInArrow(o4._cross, "a long, b long, sure boolean").collect()]
    want = {(1, 2)} | {(k, 1000 + i) for k in (1, 2) for i in range(5000)} | {(10 + i, 10 + j) for i in range(20) for j in range(i + 1, 20)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def brute_links(of: dict) -> dict:
    """Per id the number of other distinct sets at 75%."""
    sets = {i: frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []) for i, w in ((i, words(lower(t))) for i, t in of.items())}
    distinct = list(set(sets.values()) - {frozenset()})
    return {i: sum(100 * len(s & o) >= 75 * len(s | o) for o in distinct if o != s) if s else 0 for i, s in sets.items()}


def test_jaccard_every_link_is_counted(spark, docs, monkeypatch):
    got = {r.doc_id: r.n_links for r in o4.similarity_classes(docs).collect()}
    assert got == brute_links(texts(docs))
    rng = random.Random(3)
    base = [f"w{i}" for i in range(90)]
    made = {i: " ".join(f"x{rng.randrange(10**6)}" if rng.random() < 0.02 else w for w in base[: rng.randrange(70, 90)]) for i in range(150)}
    want = brute_links(made)
    assert max(want.values()) > 40
    df = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    for block in (o4.BLOCK, 20):  # 20: many pairs of blocks
        monkeypatch.setattr(o4, "BLOCK", block)
        assert {r.doc_id: r.n_links for r in o4.similarity_classes(df).collect()} == want


def test_jaccard_edges(edge):
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id) for r in o4.similarity_classes(edge).collect())
    want = {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 6: (1, 6), 7: (2, 7), -1: (2, 7)}
    assert len(got) == len(EDGE)
    assert {i: (n, c) for i, n, c in got if i in want} == want
    assert o4.similarity_classes(edge.limit(0)).count() == 0


def test_every_language_counts(spark):
    """A language behind 66 more common ones has a reference of its own, and is learned."""
    plain = lambda k: " ".join(f"the{chr(97 + (k * 7 + i) % 26)}{chr(97 + i % 26)} of word{chr(97 + i % 23)}" for i in range(40))
    rare = " ".join("".join(chr(0x430 + (i * 5 + j * j + i // 32 * j) % 32) for j in range(6)) for i in range(80))
    rows = [(12 * k + i, plain(i), f"l{k:02d}") for k in range(66) for i in range(12)] + [(10_000 + i, rare + " " + chr(0x430 + i), "zz") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in o6.quality(df).collect()}
    assert len(got) == len(rows)
    assert all(not got[10_000 + i].base_failed and got[10_000 + i].class_distance < 0.01 and got[10_000 + i].kept for i in range(8))
    langs, texts, y = o1.sample(df)
    assert langs == sorted({r[2] for r in rows}) and set(y) == set(range(67)) and len(texts) == len(y)


def test_ppm_against_brute_force(spark, docs):
    some = docs.limit(60)
    rows = {i: lower(t).encode() for i, t in texts(some).items()}
    got = {r.doc_id: r for r in o5.score(some).collect()}
    train = [t for i, t in rows.items() if zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in train for w in t.split())
    n, v = sum(c.values()) + len(train), len(c) + 1
    tries = [defaultdict(Counter) for _ in range(5)]
    for t in train:
        s = b"\0\0\0\0" + t + b"\0"
        for p in range(4, len(s)):
            for j in range(5):
                tries[j][s[p - j : p]][s[p]] += 1

    def log10p(h, s):
        out, z = set(), 0.0
        for j in range(4, -1, -1):
            live = {a: b for a, b in tries[j].get(h[4 - j :], {}).items() if a not in out}
            if not live:
                continue
            total = sum(live.values()) + len(live)
            if s in live:
                return z + math.log10(live[s] / total)
            z += math.log10(len(live) / total)
            out |= set(live)
        return z - math.log10(256 - len(tries[0][b""]))

    for i, t in rows.items():
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t.split()) + math.log10((len(train) + 0.1) / (n + 0.1 * (v + 1)))
        s = b"\0\0\0\0" + t + b"\0"
        model = sum(log10p(s[p - 4 : p], s[p]) for p in range(4, len(s)))
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t.split()) + 1, sum(c[w] > 0 for w in t.split()) + 1, n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, model, rel_tol=1e-9)


def test_ppm_edges_and_blocks(spark, edge, monkeypatch):
    one = sorted(map(str, ((r.doc_id, r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in o5.score(edge).collect())))
    assert len(one) == len(EDGE)
    monkeypatch.setattr(o5, "BLOCK", 40)
    assert sorted(map(str, ((r.doc_id, r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in o5.score(edge).collect()))) == one


def test_quality_base_counts(spark, docs):
    got = {r.doc_id: r for r in o6.quality(docs).collect()}
    for i, t in texts(docs).items():
        w = words(t)
        g = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        cover = {m for k in range(len(w) - 4) if g[tuple(w[k : k + 5])] > 1 for m in range(k, k + 5)}
        lines = [x for x in t.split("\n") if words(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        assert r.base_failed == (len(w) < 10 or 100 * len(cover) > 20 * len(w))
        assert not (r.base_failed and r.kept)


def test_quality_distances(spark, docs):
    """Symbols in every word and tables without function words are far from any language; prose is near."""
    label = {r.doc_id: r.quality for r in read(spark, SF, "labels").select("doc_id", "quality").collect()}
    good = [r.kept for r in o6.quality(docs).collect() if label.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(good) >= 0.97 * len(good)
    p, q = np.array([0.5, 0.5, 0.0]), np.array([10.0, 0.0, 10.0])
    df = spark.createDataFrame([(p.tolist(),)], "h array<double>")
    q = q / q.sum()
    m = (p + q) / 2
    want = math.sqrt(sum(x * math.log2(x / y) for x, y in zip(p, m, strict=True) if x) / 2 + sum(x * math.log2(x / y) for x, y in zip(q, m, strict=True) if x) / 2)
    assert math.isclose(df.select(o6.distance("h", [10.0, 0.0, 10.0])).first()[0], want, rel_tol=1e-12)


def test_quality_histograms(spark):
    """Every character is in one class, whatever its bytes; common words count without case and marks."""
    cases = {1: "The end, of (the) WORLD! 42%", 2: "中文字 и слово é 👍 x", 3: None, 4: "THE the, The. of; in\u00a0is"}
    got = {r.doc_id: r for r in o6.features(spark.createDataFrame([(i, t, "en") for i, t in cases.items()], "doc_id long, text string, lang string")).collect()}
    for i, t in cases.items():
        t = t or ""
        count = [sum(c in x for c in t) for x in (o6.LOWER, o6.UPPER, o6.DIGITS, o6.SPACE, o6.SYMBOLS)] + [sum(ord(c) > 127 for c in t)]
        assert list(got[i].classes) == [*count, len(t) - sum(count)]
    place = {w: k for k, w in enumerate(o6.WORDS)}
    assert got[1].frequent[place["the"]] == 2 and got[1].frequent[place["of"]] == 1 and got[1].frequent[-1] == 3
    assert got[4].frequent[place["the"]] == 3 and got[4].frequent[place["of"]] == 1


def test_sql_of_the_corpus_queries(spark):
    """The registered SQL in DuckDB against the queries."""
    import duckdb

    from lakegrid.llm.queries import ORACLES

    db = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "embeddings"):
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in ORACLES.items():
        ours, theirs = QUERIES[name](spark, SF), db.sql(sql)
        columns = sorted(ours.columns)
        assert columns == sorted(theirs.columns), name
        assert sorted(tuple(r[c] for c in columns) for r in ours.collect()) == sorted(theirs.select(*columns).fetchall()), name


def test_quality_edges(edge):
    got = o6.quality(edge).collect()
    assert len(got) == len(EDGE) and all(not r.kept for r in got if r.n_words < 10)
    assert next(r for r in got if r.doc_id == 6).n_repeat_words == 30_000
    assert o6.quality(edge.limit(0)).count() == 0


def pair_terms(model, found):
    b, w, v = model
    return np.array([0.5 * ((v[f].sum(0) ** 2).sum() - (v[f] ** 2).sum()) for f in found]), np.array([b + w[f].sum() for f in found])


def test_toxicity_learns_pairs():
    """With the shipped values: two terms that are toxic only with, or only without each other; additive weights can't tell, the machine can."""
    rng = np.random.RandomState(0)
    found, y = [], []
    for _ in range(3000):
        a, b = rng.rand(2) < 0.5
        found.append(np.array(sorted({7} | ({11} if a else set()) | ({13} if b else set())), np.int32))
        y.append(float(a != b))
    pair, plain = pair_terms(o7.train(np.array(y), found), found)
    assert np.mean((pair + plain > 0) == (np.array(y) > 0.5)) > 0.95


def test_toxicity_pairs_matter_in_real_texts(spark):
    """An insult (term 11) that is toxic only beside a group's name (term 13), planted in the table's texts: the pair term decides."""
    rng = np.random.RandomState(3)
    y, found = o7.training_rows(read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels"))
    found = found * 6
    planted = rng.rand(len(found), 2) < 0.3
    found = [np.unique(np.concatenate((f, [11] * int(a), [13] * int(b)))).astype(np.int32) for f, (a, b) in zip(found, planted, strict=True)]
    y = planted.all(1).astype(float)
    cut = len(y) * 3 // 4
    pair, plain = pair_terms(o7.train(y[:cut], found[:cut]), found[cut:])
    with_pairs, without = (np.mean((z > math.log(0.3 / 0.7)) == (y[cut:] > 0.5)) for z in (pair + plain, plain))
    assert with_pairs > 0.97 and with_pairs > without + 0.03 and np.abs(pair).max() > 1


def test_toxicity_scores_are_the_model_s(spark, docs):
    """Scores from the plan against the sum over all pairs, term by term; documents that hold several insults are found."""
    labels = read(spark, SF, "labels")
    b, w, v = o7.train(*o7.training_rows(docs, labels))
    got = {r.doc_id: r for r in o7.toxicity(docs, labels).collect()}
    of = texts(docs)
    for i in sorted(of)[:60]:
        f = np.unique(o7.slots(pa.array([of[i]]))[0])
        f = f[(w[f] != 0) | (v[f] != 0).any(1)].tolist()
        z = b + sum(float(w[a]) for a in f) + sum(float(v[a].astype(float) @ v[c]) for k, a in enumerate(f) for c in f[:k])
        assert math.isclose(got[i].score, 1 / (1 + math.exp(-min(30, max(-30, z)))), rel_tol=1e-4, abs_tol=1e-9)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and got[i].predicted == int(got[i].score >= 0.3)


def test_toxicity_held_out_recall(spark):
    """Held-out documents with two insults or more, which are all toxic."""
    sf = "/root/testdata/sf0.1"
    insults = "trash clown idiot scum worthless moron pathetic loser disgusting stupid".split()
    rows = o7.toxicity(read(spark, sf, "documents"), read(spark, sf, "labels")).filter("held_out").join(read(spark, sf, "documents").select("doc_id", "text"), "doc_id").join(read(spark, sf, "labels"), "doc_id").collect()
    sure = [r for r in rows if len({w for w in re.findall("[a-z]+", (r.text or "").lower())} & set(insults)) >= 2]
    clean = [r for r in rows if r.toxic == 0]
    assert len(sure) > 30 and sum(r.predicted for r in sure) >= 0.9 * len(sure) and sum(r.predicted for r in clean) <= 0.01 * len(clean)


def test_toxicity_edges(spark, edge):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in o7.toxicity(edge, none).collect()} == {0.5}
    some = spark.createDataFrame([(4, 1, 1), (7, 0, 0), (6, None, None)], "doc_id long, quality int, toxic int")
    got = o7.toxicity(edge, some).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert o7.toxicity(edge.limit(0), some).count() == 0


def test_token_counts_and_every_prefix(edge, docs):
    lib = o8.counter(o8.public_tokenizers.path(o8.VOCABULARY)).library
    n = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    for df in (edge, docs.limit(50)):
        rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
        got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in o8.token_counts(df).collect())
        assert got == sorted((i or -1, len(t.encode()), n(t), n(t) > 2048) for i, t in rows)
    assert o8.token_counts(edge.limit(0)).count() == 0
    few = docs.limit(40)
    for r in o8.token_counts(few, limit=100).collect():  # the prefix fits, and one more word doesn't
        t = texts(few)[r.doc_id]
        if n(t) > 100:
            end = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+").match(t, r.fit_chars).end()
            assert n(t[: r.fit_chars]) <= 100 < n(t[:end]) and r.over_limit
        else:
            assert r.fit_chars == len(t) and not r.over_limit
    table = o8.counter(o8.public_tokenizers.path(o8.VOCABULARY))
    hard = ("!!<|endoftext|><|endoftext|>ab'll'", "日本語 ﬁxé e\u0301a\u0301 \u00a0x\u2003y ''s '' 't", "<|endoftext|" * 3)
    for t in ("Therouha, anonon'll réeuxre 42!", "aaaaaaaaaab <|endoftext|>x", "hello  hello\n", *hard):
        assert table.prefix_table(t).tolist() == [n(t[:k]) for k in range(len(t) + 1)]
        cut = table.longest_prefix(t, 3)
        assert n(t[:cut]) <= 3
    cuts = {r.doc_id: (r.n_chars, r.n_tokens) for r in o8.truncated(docs.limit(20), 50).collect()}
    for i, t in texts(docs.limit(20)).items():
        assert n(t[: cuts[i][0]]) == cuts[i][1] <= 50


def test_token_counts_of_long_words():
    """Runs of special strings, marks and letters of one word: no recursion, time in line with the length."""
    table = o8.counter(o8.public_tokenizers.path(o8.VOCABULARY))
    n = lambda t: len(table.library.encode(t, add_special_tokens=False).ids)
    assert table.total("<|endoftext|>" * 100_000) == 100_000
    t = "a<|endoftext|>!" * 300
    assert table.total(t) == n(t) and table.prefix_table(t)[-1] == n(t)
    for t in ("!" * 3000, "é" * 2000, "ab1" * 1000):
        got = table.prefix_table(t)
        assert got[-1] == n(t) and all(got[k] == n(t[:k]) for k in range(0, len(t), 97))
    ends, counts = table.at_words("  one two\n")
    assert ends.tolist() == [5, 9] and counts.tolist() == [n("one"), n("one two")]


def test_pii():
    text = "mail a.b@x.org, 10.0.0.256 then 10.0.0.1 card 4111 1111 1111 1111 tel +1 (017) 555-7713 IBAN DE89 3704 0044 0532 0130 00 and DE89 3704 0044 0532 0130 01; ssn 123-45-6789; order 123-45-6789"
    spans = o9.base_spans(text)
    assert [(k, text[a:b]) for k, a, b in spans] == [("email", "a.b@x.org"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (017) 555-7713")]
    more = o9.more_spans(text, o9.free_of_overlaps(spans))
    assert [text[a:b] for k, a, b, s in more if k == "iban"] == ["DE89 3704 0044 0532 0130 00"]
    ssn = lambda t: [t[a:b] for k, a, b, s in o9.more_spans(t, []) if k == "ssn"]
    assert ssn("ssn 123-45-6789") == ["123-45-6789"] and ssn("order 123-45-6789") == []
    assert o9.more_spans("iban DE89 3704 0044 0532 0130 00", [(5, 30)]) == []  # what a base span takes is no other
    assert o9.luhn("4111111111111111") and not o9.luhn("4111111111111112")
    near, plain, against = (o9.scored(t, "phone", 6, 19) for t in ("call: +1 555 123 456", "xxxx: +1 555 123 456", "order +1 555 123 456"))
    assert near > plain > against


def plain_spans(text):
    """The base kinds by their patterns as given."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 16 <= len(d) <= 19 and sum(d[0::2] + [x // 5 + x * 2 % 10 for x in d[1::2]]) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.findall("[0-9]", m[0])) <= 15]


def test_pii_is_what_the_patterns_find(docs):
    """Brute force over the table's texts and over texts made of the patterns' own characters."""
    rng = random.Random(12)
    made = ["".join(rng.choice(["@", "@", ".", "a", "b.c", "0", "1", "25", "255", "256", "001", "+", "-", " ", "(", ")", "%", "_", "é", "\n", "4111 1111 1111 1111", "1.2.3.4"]) for _ in range(rng.randrange(2, 40))) for _ in range(20_000)]
    for t in [*texts(docs).values(), *made]:
        assert o9.base_spans(t) == plain_spans(t), repr(t)


def test_pii_long_runs(spark):
    """Texts of a million characters of one kind end in time, and numbers of any length do no harm."""
    import time

    n = 1_000_000
    cases = ["a" * n, "1" * n, "a." * (n // 2), "1." * (n // 2), "a@" * (n // 2), "a@b" * (n // 3), "+" * n, "+1" + "." * n, "1 " * (n // 2), "0" * 5000 + ".1.1.1", "1.1.1." + "9" * 5000, "password " * (n // 9), "password" + " " * n, "A" * n, "AB12 " * (n // 5), "123-45-6789 " * (n // 12), "a@b.c " * (n // 6)]
    began = time.time()
    got = {r.doc_id: r for r in o9.find_pii(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")).collect()}
    assert time.time() - began < 120 and len(got) == len(cases)
    assert got[9].n_ip == 1 and got[10].n_ip == 0 and got[16].n_email == n // 6


def test_pii_frame(edge):
    got = o9.find_pii(edge, redact=True).collect()
    assert len(got) == len(EDGE)
    assert next(r for r in got if r.doc_id == 1).base_sha256 == hashlib.sha256(b"").hexdigest()
    assert o9.find_pii(edge.limit(0)).count() == 0


def test_decontamination(spark):
    rng = random.Random(2)
    item = [f"t{rng.randrange(10**6)}" for _ in range(40)]
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    cases = {1: noise(200), 2: noise(50) + item + noise(50), 3: item[20:] + noise(9) + item[:20], 4: noise(30) + item[:12] + noise(30), 5: [w.upper() + "," for w in item], 6: item[:5] * 8}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in cases.items()] + [(7, None), (8, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "too short"), (3, None)], "item_id long, text string")
    got = {r.doc_id: r for r in o10.leaks(docs, bench).collect()}
    assert sorted(got) == [2, 3, 5] and got[3].n_tiles == 2 and all(r.covered == 40 for r in got.values())
    assert o10.leaks(docs, bench.limit(0)).count() == 0


def plain_tiling(doc, item, least=5):
    """Greedy string tiling by definition: again and again the longest match of free terms (ties: first in doc, then item)."""
    free_d, free_i, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and free_d[i + n] and free_i[j + n] and doc[i + n] == item[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        free_d[i : i + n] = free_i[j : j + n] = [False] * n
        out.append((i, j, n))


def test_decontamination_is_greedy_tiling(spark, monkeypatch):
    """Brute force over documents made of pieces of items, in any order, with repeats; in portions of any size."""
    rng = random.Random(9)
    items = {k: [f"w{rng.randrange(12)}" for _ in range(rng.randrange(5, 30))] for k in range(12)} | {20: ["just", "three", "terms"], 21: ["one"]}
    made = {}
    for k in range(60):
        w = []
        for _ in range(rng.randrange(1, 5)):
            x = items[rng.randrange(12)]
            a = rng.randrange(len(x) - 4)
            w += x[a : a + rng.randrange(4, 20)] + [f"n{rng.randrange(99)}"] * rng.randrange(3)
        made[k] = w
    made |= {60: ["Just", "three", "TERMS"], 61: ["just", "three", "terms", "more"], 62: ["one"], 63: items[3] * 40}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in made.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    want = set()
    for i, d in made.items():
        for t, x in items.items():
            low = [w.lower() for w in d]
            found = plain_tiling(low, x) if len(x) >= 5 else [(0, 0, len(x))] if low == x else []
            covered = sum(n for _, _, n in found)
            if covered and 2 * covered >= len(x):
                want.add((i, t, len(found), covered))
    for places in (o10.PLACES, 7):
        monkeypatch.setattr(o10, "PLACES", places)
        assert {(r.doc_id, r.item_id, r.n_tiles, r.covered) for r in o10.leaks(docs, bench).collect()} == want
    assert {(60, 20), (62, 21)} <= {x[:2] for x in want} and not {61} & {x[0] for x in want if x[1] == 20}


def test_decontamination_edges(spark, edge):
    """Null ids and texts, repeated rows, other columns of the same names, and very long texts."""
    item = "one two three four five six"
    bench = spark.createDataFrame([(None, item, "x"), (1, item, "x"), (1, item, "x"), (2, "word " * 5000, "x"), (3, None, "x"), (4, "", "x")], "item_id long, text string, key string")
    got = sorted(((r.doc_id or -1), (r.item_id or -1)) for r in o10.leaks(edge, bench).collect())
    assert got == sorted([(-1, -1), (-1, 1), (-1, 1), (7, -1), (7, 1), (7, 1), (6, 2)])
    assert o10.leaks(edge.limit(0), bench).count() == 0


def test_tiles_do_not_overlap():
    rng = np.random.RandomState(4)
    for _ in range(30):
        doc, item = rng.randint(0, 3, 60).astype(np.uint64), rng.randint(0, 3, 40).astype(np.uint64)
        pairs = [(i, j) for i in range(56) for j in range(36) if (doc[i : i + 5] == item[j : j + 5]).all()]
        if not pairs:
            continue
        i, j = (np.array(x) for x in zip(*pairs, strict=True))
        seen_d, seen_i = set(), set()
        tiles = o10.tiles(doc, item, (i, j))
        for a, b, n in tiles:
            assert n >= 5 and (doc[a : a + n] == item[b : b + n]).all()
            assert not seen_d & set(range(a, a + n)) and not seen_i & set(range(b, b + n))
            seen_d |= set(range(a, a + n))
            seen_i |= set(range(b, b + n))
        assert tiles[0][2] == max(t[2] for t in tiles)
        left = [(a, b) for a, b in pairs if not seen_d & set(range(a, a + 5)) and not seen_i & set(range(b, b + 5))]
        assert not left


def test_tiles_of_repeated_terms():
    """The walk over diagonals takes the tiles that all pairs give; long repeats need little memory."""
    rng = np.random.RandomState(8)
    for k in range(40):
        doc, item = rng.randint(0, 2 + k % 2, 70).astype(np.uint64), rng.randint(0, 2 + k % 2, 50).astype(np.uint64)
        pairs = [(i, j) for i in range(66) for j in range(46) if (doc[i : i + 5] == item[j : j + 5]).all()]
        i, j = (np.array(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int), np.zeros(0, int))
        want = o10.tiles(doc, item, (i, j))
        for most in (1, 7, 10_000):
            assert o10.tiles_of_repeats(doc, item, most=most) == want
    items = o10.Items([1], ["0 " * 5_000])
    tracemalloc.start()
    (r, t, found), *more = items.matches(pa.array(["0 " * 100_000]), 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (r, t, found, more) == (0, 0, [(0, 0, 5_000)], []) and peak < 200e6


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = read(spark, SF, "documents")
    for name, stage in p.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = o3.written(out)
    last = p.STAGES[4][1](spark, docs, SF).collect()
    assert len(last) == docs.count() and len({r.doc_id for r in last}) == len(last)


def test_words_are_parted_by_rows():
    from lakegrid.llm import shared

    raw, at = shared.text_bytes(pa.array(["ab c", None, "c", "", "d e"]))
    start, end, row = shared.words(raw, at)
    assert [bytes(raw[a:b]) for a, b in zip(start, end, strict=True)] == [b"ab", b"c", b"c", b"d", b"e"] and row.tolist() == [0, 0, 2, 4, 4]
    h = shared.word_hashes(raw, start, end)
    assert h[1] == h[2] and len(set(h.tolist())) == 4
