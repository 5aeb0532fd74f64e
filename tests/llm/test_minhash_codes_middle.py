"""MinHash classes, vector codes and fill-in-the-middle against brute force and edge cases."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

pytest.importorskip("lakegrid.llm")
from lakegrid.llm import op11_minhash as o11  # noqa: E402
from lakegrid.llm import op12_vector_codes as o12  # noqa: E402
from lakegrid.llm import op13_fill_middle as o13  # noqa: E402
from lakegrid.llm.queries import QUERIES  # noqa: E402
from lakegrid.llm.shared import read  # noqa: E402

SF = "/root/testdata/sf0.001"
EDGE = [(1, None), (2, ""), (3, "   \n\t"), (4, "one two"), (4, "one two"), (None, "one two"), (None, "alone here it is"), (6, "word " * 30_000), (7, "ONE"), (8, "é ñ ü 日本 👍 <|endoftext|> x\x00y"), (9, "one  two\n\nthree\r\n four "), (10, "a<P>b"), (11, "One\tTWO")]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "en", "s", 1, 5, "clash", 7) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score long, high string, label long")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def shingles(t):
    w = words(t)
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def classes(texts):
    """Smallest id reachable, from all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            i, j = sorted((root(a), root(b)))
            label[j] = i
    return {i: root(i) for i in sets}


def test_minhash_classes_are_the_exact_ones(spark):
    docs = read(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want, got = classes(texts), QUERIES["op11_minhash"](spark, SF).collect()
    assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(texts)
    assert all(r.n_shingles == len(shingles(texts[r.doc_id])) and r.kept == (r.doc_id == want[r.doc_id]) for r in got)


def test_minhash_chains_borders_and_large_groups(spark, monkeypatch):
    """Chains of near copies, pairs at exactly and just below 80 %, and a group of many classes, with small blocks and salts and every key counted as hot."""
    monkeypatch.setattr(o11, "BLOCK", 16)
    monkeypatch.setattr(o11, "SALTED", 5)
    monkeypatch.setattr(o11, "HOT", 4)
    rng = random.Random(3)
    base = [f"w{k}" for k in range(200)]
    texts, now = {}, list(base)
    for i in range(60):  # a chain: each a few words from the last, its ends far apart
        now = list(now)
        for k in rng.sample(range(200), 5):
            now[k] = f"c{i}x{k}"
        texts[i] = " ".join(now)
    for i in range(100, 180):  # a group whose members are about 70 to 85 % alike
        own = list(base)
        for k in rng.sample(range(200), rng.randint(5, 12)):
            own[k] = f"g{i}x{k}"
        texts[i] = " ".join(own)
    line = [f"b{k}" for k in range(91)]  # 90 shingles; 80 in common of 100, and of 101
    texts[300], texts[301], texts[302] = " ".join(line), " ".join(line[:81] + [f"e{k}" for k in range(10)]), " ".join(line[:81] + [f"f{k}" for k in range(11)])
    want = classes(texts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    assert want[301] == 300 and want[302] == 302
    assert {r.doc_id: r.component_id for r in o11.near_duplicates(docs).collect()} == want


def test_sequential_bounds():
    """A pair at the threshold is pruned about never, one far below soon."""
    rng = np.random.RandomState(0)

    def pairs(similarity, n):
        x = rng.randint(0, 2, (n, o11.KEPT)).astype(np.uint8)
        y = np.where(rng.rand(n, o11.KEPT) < similarity, x, rng.randint(0, 2, (n, o11.KEPT))).astype(np.uint8)
        return [np.packbits(z, 1).view(np.uint64) for z in (x, y)]

    assert len(o11.matched(*pairs(0.8, 20_000))[0]) >= 19_995
    assert len(o11.matched(*pairs(0.6, 2_000))[0]) == 0
    least = o11.least_matches()
    assert list(least) == sorted(least) and least[-1] < 0.9 * o11.KEPT
    rows, matches = o11.matched(*pairs(0.9, 10))
    assert rows.tolist() == list(range(10)) and (matches > 0.9 * o11.KEPT).all()
    assert (1 - 0.8**o11.ROWS) ** o11.BANDS <= o11.MISS


def test_signature_bits_agree_as_sets_do():
    """Bands and bits estimate the similarity of two sets."""
    rng = np.random.RandomState(1)
    h = rng.randint(0, 2**62, 1200).astype(np.uint64) * np.uint64(3)
    a, b = np.sort(h[:1000]), np.sort(h[200:])  # 800 in common of 1200
    least, bits = o11.signatures(np.concatenate((a, b)), np.array([0, 1000]))
    assert abs((least[:, 0] == least[:, 1]).mean() - 2 / 3) < 0.12
    same = o11.KEPT - np.bitwise_count(bits[0] ^ bits[1]).sum()
    assert abs(2 * same / o11.KEPT - 1 - 2 / 3) < 0.06


def test_minhash_edges(edge):
    assert o11.near_duplicates(edge.limit(0)).collect() == []
    got = o11.near_duplicates(edge).collect()
    assert len(got) == len(EDGE)
    by = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got}
    assert by[1, 0] == (1, True) and by[2, 0] == (2, True) and by[3, 0] == (3, True)
    assert by[4, 1] == (4, True) and by[11, 1] == (4, False) and by[None, 1] == (4, False)
    assert by[None, 3] == (None, True) and by[6, 1] == (6, True) and by[7, 1] == (7, True)


def by_hand(rows):
    """Codes and codebooks by comparing every part with every entry."""
    kept = sorted((i, [int(np.floor(1024 * float(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v))
    cut = [[x[k * len(x) // 4 : (k + 1) * len(x) // 4] for _, x, _ in kept] for k in range(4)]
    books = [p[:256] for p in cut]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(4):
        for k in range(4):
            own = [nearest(books[k], x)[1] for x in cut[k]]
            books[k] = [[sum(c) // len(c) for c in zip(*(x for x, o in zip(cut[k], own, strict=True) if o == e), strict=True)] or list(old) for e, old in enumerate(books[k])]
    found = [[nearest(books[k], x) for x in cut[k]] for k in range(4)]
    error = [sum(f[n][0] for f in found) for n in range(len(kept))]
    sums = {}
    for (_, _, label), e in zip(kept, error, strict=True):
        sums[label] = sums.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {(i, "".join(f"{f[n][1]:02x}" for f in found), error[n], sums[label], digest) for n, (i, _, label) in enumerate(kept)}


VECTORS = "vec_id long, embedding array<float>, label int, code string"


def test_vector_codes_by_hand(spark, monkeypatch):
    """Ties, repeated vectors, unused entries, dropped rows, clashing columns, a null label; portions of two entries; every label hot."""
    monkeypatch.setattr(o12, "PORTION", 2)
    monkeypatch.setattr(o12, "HOT", 1)
    rng = random.Random(5)
    rows = [(i, [rng.choice((-0.25, 0.0, 0.1, 0.3, 0.5)) for _ in range(8)], rng.choice((0, 1, None))) for i in range(40)]
    rows += [(40, None, 1), (41, [None] + [0.5] * 7, 1), (42, [float("nan")] * 8, 1), (43, [float("-inf")] + [0.0] * 7, 0)]
    rows += [(50 + i, [rng.gauss(0, 0.2) for _ in range(8)], 2) for i in range(300)]
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    df = spark.createDataFrame([(*r, "clash") for r in rows], VECTORS).repartition(5)
    codes, books = o12.compressed(df)
    assert {tuple(r) for r in codes.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()} == by_hand(rows)
    assert [len(b) for b in books] == [256] * 4


def test_orchard_is_exact():
    rng = np.random.RandomState(4)
    for entries, length, spread in ((1, 3, 5), (7, 2, 3), (256, 16, 400), (256, 4, 2), (200, 1, 50)):
        book, x = rng.randint(-spread, spread + 1, (entries, length)), rng.randint(-spread, spread + 1, (3000, length))
        far = ((x[:, None] - book) ** 2).sum(2)
        code, distance = o12.Orchard(book).nearest(x)
        assert (code == far.argmin(1)).all() and (distance == far.min(1)).all()
    far = np.array([[-1], [1]]) * o12.largest(1)
    assert o12.Orchard(far).nearest(far)[0].tolist() == [0, 1]


def test_vector_codes_edges(spark):
    assert o12.compressed(spark.createDataFrame([], VECTORS))[0].collect() == []
    odd = [(1, [0.5, 0.25, -0.5], 1, ""), (1, [0.5, 0.25, -0.5], 1, ""), (2, [3e38, -3e38, 0.0], 1, ""), (3, [0.1], None, ""), (None, [0.5, 0.25, -0.5], None, "")]
    got = o12.compressed(spark.createDataFrame(odd, VECTORS))[0].collect()
    assert len(got) == 4 and all(r.error == 0 for r in got) and {r.code for r in got if r.vec_id == 1} == {"00000000"}


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def middle_by_hand(doc_id, text):
    text = text or ""
    u = UNIT.findall(text)
    assert "".join(u) == text
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, len(u), "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_fill_middle_by_hand(spark, edge):
    """Whole tables and edge cases, with the text rebuilt from form and output."""
    rng = random.Random(6)
    more = [(i, "".join(rng.choice(" \n\tab日é👍<PSM>") for _ in range(rng.randint(0, 4000)))) for i in range(1000, 1150)] + [(2000, "x" * 100_000), (2001, " " * 5000), (2002, ("é" * 1023 + " ") * 50)]
    for docs in (read(spark, SF, "documents").select("doc_id", "text"), edge.select("doc_id", "text"), spark.createDataFrame(more, "doc_id long, text string")):
        texts = [tuple(r) for r in docs.collect()]
        want = sorted((middle_by_hand(*t) for t in texts), key=str)
        out = o13.fill_in_middle(docs)
        assert sorted((tuple(r) for r in out.collect()), key=str) == want
        digests = o13.fill_in_middle(docs, digests=True).collect()
        assert sorted(((*tuple(r)[:5], r.output_sha256) for r in digests), key=str) == sorted(((*w[:5], sha(w[5])) for w in want), key=str)
        assert sorted(r.restored_sha256 for r in digests) == sorted(sha(t or "") for _, t in texts)
        assert sorted(tuple(r) for r in o13.fill_in_restored(out).na.fill("").na.fill(-1).collect()) == sorted((-1 if i is None else i, t or "") for i, t in texts)
    assert o13.fill_in_middle(edge.limit(0)).collect() == []


def test_blocks_cut_everywhere():
    """Every cut of the tree against the list of units, for blocks of few bytes; nodes after a change against a new tree."""
    rng = random.Random(7)
    for block in (1, 2, 3, 7, 64):
        for _ in range(20):
            text = "".join(rng.choice("  \nabé日👍") for _ in range(rng.randint(1, 120)))
            units = UNIT.findall(text)
            tree = o13.Blocks(np.frombuffer(text.encode(), np.uint8), block)
            assert (tree.units, tree.points) == (len(units), len(text))
            for k in range(len(units) + 1):
                head = "".join(units[:k])
                assert tree.cut(k) == (len(head.encode()), len(head))
    a, b = (np.frombuffer(t, np.uint8) for t in (b"ab cd ef gh ij kl", b"ab cd e  gh ij kl"))
    one, other = o13.Blocks(a, 4), o13.Blocks(b, 4)
    for k in range(one.count):
        part = slice(4 * k, 4 * k + 4)
        one.changed(k, int(o13.unit_ends(b)[part].sum()) - int(o13.unit_ends(a)[part].sum()), 0)
    assert (one.tree == other.tree).all()


def test_restored_with_half_sentinels():
    """Parts that end or begin with pieces of a sentinel."""
    for p, m, s in itertools.product(("", "<", "<S", "<P", "M>", "a"), repeat=3):
        text = (p + m + s).encode()
        if any(x in text for x in (b"<P>", b"<S>", b"<M>")):
            continue
        assert o13.restored("psm", f"<P>{p}<S>{s}<M>{m}".encode()) == text
        assert o13.restored("spm", f"<S>{s}<P>{p}<M>{m}".encode()) == text


def test_slices_do_not_change_results(spark):
    """The same rows in one and in many partitions."""
    docs = read(spark, SF, "documents")
    for f in (lambda d: o13.fill_in_middle(d, digests=True), lambda d: o11.near_duplicates(d.limit(60))):
        assert sorted(map(str, f(docs.orderBy("doc_id").coalesce(1)).collect())) == sorted(map(str, f(docs.orderBy("doc_id")).collect()))
