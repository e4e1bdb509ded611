"""The dealt operators against plain versions, on rows with nulls, empty, long, equal and repeated texts."""

import hashlib
import math
import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from oracle import connect, differences

from ledgerlens.llm import (
    components, decontaminate, elias_fano, html_text, jaccard, language_model, licenses, mixing, queries, repeats,
    token_files, topk, toxicity,
)

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, node long, tid string, part int"


def sentence(rng, n):
    return " ".join(rng.choice(["the", "of", "Alpha", "beta", f"w{rng.randrange(4000)}", f"x{rng.randrange(900)},"]) for _ in range(n))


def odd_texts():
    rng = random.Random(7)
    passage, long = sentence(rng, 60), sentence(rng, 30_000)
    base = sentence(rng, 120)
    changed = base.split()
    changed[50] = "changed"
    return [
        (0, None), (1, ""), (2, " \n\t "), (3, long), (4, base), (5, base), (5, base), (6, sentence(rng, 20) + " " + passage),
        (7, "Two words"), (8, "two  WORDS"), (9, passage + "\n" + sentence(rng, 30)), (10, " ".join(changed)), (None, "no id here"),
        (11, "same " * 300), (12, "same " * 120 + "end"), (13, "é ñ <|endoftext|> a b  c \n d"), (14, long + " tail"),
        (14, sentence(rng, 70)),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", None if (i or 0) % 4 == 0 else f"s{(i or 0) % 3}", 0, 1, 0.5, 7, "t", 1) for i, t in odd_texts()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.translate(LOWER) if lower else raw).split()


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((0, 10), (1, 1), (500, 600), (3000, 2**40), (400, 2**63)):
        values = np.unique(rng.integers(0, top, n).astype(np.uint64))
        made = elias_fano.EliasFano.build(values, top)
        read, _ = elias_fano.EliasFano.read(np.concatenate(made.arrays()))
        assert (read.get(np.arange(len(values))) == values).all()
        asked = np.concatenate([values, rng.integers(0, top, 300).astype(np.uint64)])
        where = {int(v): i for i, v in enumerate(values)}
        assert read.find(asked).tolist() == [where.get(int(x), -1) for x in asked]


def test_components(spark):
    links = [(2, 1), (2, 3), (3, 3), (9, 8), (7, 8), (7, 12), (12, 1000), (50, 49)] + [(100 + i, 101 + i) for i in range(40)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found[3] == 1 and found[1000] == 7 and found[49] == 49 and {found[100 + i] for i in range(41)} == {100}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# 1


def brute_topk(rows, k=5):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault((i, tuple(math.floor(256 * x) for x in v)), None)
    out = []
    asked = {}
    for i, v in usable:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def test_topk(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    rows += [(400 + i, rows[50][1]) for i in range(300)]  # many ties
    rows += [(50, rows[50][1]), (51, rows[51][1]), (None, rows[1][1]), (800, None), (801, []), (802, [0.1, None, 0.0, 0.0, 0.0, 0.0])]
    rows += [(850, [float("nan")] * 6), (900, [float("inf")] * 6), (950, [0.5, -0.5]), (951, [0.25, 1.0]), (1000, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, width string")
    found = sorted(tuple(r) for r in topk.op1_topk(df).collect())
    assert found == brute_topk(rows)
    # Shards and slices of other sizes give the same rows.
    vectors = df.select("vec_id", topk.whole_numbers("embedding").alias("vector"))
    again = topk.nearest_exact(vectors, vectors.filter("vec_id % 50 = 0"), 5, shard=64, per_slice=3)
    assert sorted(tuple(r) for r in again.collect()) == found
    assert topk.op1_topk(df.limit(0)).count() == 0


def test_lists_stop_early():
    rng = np.random.default_rng(2)
    matrix = rng.integers(-20, 20, (2000, 4))
    matrix[77] = [250, 250, 250, 250]
    order = np.argsort(matrix, axis=0, kind="stable").T.astype(np.int32)
    lists = topk.Lists(4, np.arange(2000).tobytes(), np.ascontiguousarray(order).tobytes(), matrix.astype(np.int64).tobytes())
    [(q, left)] = list(lists.best(np.array([-1]), np.array([[3, 3, 3, 3]]), np.array([-np.inf]), 1))
    assert q == 0 and 77 in left and len(left) < 2000 // 16


# 2

PAGES = [
    ("<html><head><title>T</title></head><body><nav>menu</nav><article><h1>Head &amp; x</h1><p>One<b>two</b><br>three<p>Four &lt;b&gt;"
     "<div class='ad-box'>buy</div><aside>side</aside><form>f</form><script>var a='</p>'</script><ul><li>a<li>b</ul><section id=comments>"
     "<p>c</p></section></article><footer>foot</footer>", "Head & x\nOnetwo three\nFour <b>\na\nb"),
    ("", ""), (None, ""), ("plain  text &eacute;\nwith lines", "plain text é with lines"),
    ("<article><p>unclosed <i>and <!-- no end", "unclosed and"), ("<p title=\"a > b\">kept</p><p hidden>gone</p>", "kept"),
    ("<div role=main><header>h</header><p>m</p></div><p>out</p>", "m"),
]


def test_html(spark):
    rows = [(i, f"http://h{i}.example/a", h, "x") for i, (h, _) in enumerate(PAGES)] + [(0, "http://h0.example/a", PAGES[0][0], "x")]
    # On one host most pages have the same block outside an article; elsewhere it is text.
    rows += [(100 + i, "https://u@Site.example:80/p", f"<body><div>Our shop</div><p>Own text {i}</p></body>", "x") for i in range(10)]
    rows += [(200, "https://other.example", "<body><div>Our shop</div><p>Own text</p></body>", "x"), (201, None, "<p>a</p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = defaultdict(list)
    for r in html_text.op2_html_text(df).collect():
        found[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert [found[i][0] for i in range(len(PAGES))] == [t for _, t in PAGES] and len(found[0]) == 2
    assert [found[100 + i] for i in range(10)] == [[f"Own text {i}"] for i in range(10)]
    assert found[200] == ["Our shop\nOwn text"] and found[201] == ["a"]
    assert html_text.op2_html_text(df.limit(0)).count() == 0


def test_html_templates_inside_articles(spark):
    rng = random.Random(22)
    box = "<div class='x7'><p>Read all our stories</p><ul><li>one</li><li>two</li></ul></div>"
    story = [sentence(rng, 30) for _ in range(8)]
    rows = [(i, "http://a.example/", f"<main><h1>Daily</h1><p>{t}</p>{box}</main>") for i, t in enumerate(story)]
    # Copies and near copies of an article with its own box, on a host of their own.
    rows += [(20 + i, "http://b.example/", f"<article><div><p>{story[0]}</p></div></article>") for i in range(8)]
    rows += [(40 + i, "http://c.example/", f"<article><p>Page {i}</p><div><p>{story[0]}</p></div></article>") for i in range(8)]
    # The story is outside; a teaser is marked.
    rows += [(60, "http://d.example/", f"<div><p>{story[1]}</p></div><article><p>Next</p></article>")]
    # On a hundred of many pages.
    rows += [(100 + i, "http://e.example/", f"<article><p>Own text {i}</p>{box if i % 4 == 0 else ''}<p>{story[i % 8]}</p></article>") for i in range(440)]
    found = {r.page_id: r.text for r in html_text.op2_html_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    flat = [" ".join(t.split()) for t in story]
    assert [found[i] for i in range(8)] == [f"Daily\n{t}" for t in flat]
    assert all(found[20 + i] == flat[0] and found[40 + i] == f"Page {i}\n{flat[0]}" for i in range(8))
    assert found[60] == f"{flat[1]}\nNext"
    assert all(found[100 + i] == f"Own text {i}\n{flat[i % 8]}" for i in range(440))


# 3


def test_token_files(spark, odd, empty):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(token_files.tokenizer_file())
    start, expected = 0, defaultdict(list)
    found = sorted(token_files.op3_token_files(odd).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted([i for i, _ in odd_texts() if i is not None]) + [None]
    for i, text in odd_texts():
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        expected[i].append((len(ids), zlib.crc32(ids.tobytes())))
    for r in found:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in expected[r.doc_id]
        expected[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
    small = token_files.write_token_files(odd, per_block=500)
    assert small.blocks.count() >= 3
    again = {(r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(small).collect()}
    assert again == {(r.doc_id, r.n_tokens, r.ids_crc32) for r in found}
    assert token_files.op3_token_files(empty).count() == 0


def test_code_round_trip():
    rng = np.random.default_rng(4)
    for counts in ([5], [1, 1], [2**i for i in range(40)], rng.integers(0, 9, 3000).tolist()):
        counts = np.array(counts)
        lengths = token_files.code_lengths(counts, 18)
        assert lengths.max() <= 18 and ((lengths > 0) == (counts > 0)).all() and (2.0 ** -lengths[lengths > 0].astype(float)).sum() <= 1
        ids = rng.choice(np.flatnonzero(counts), 5000)
        code = token_files.Code(lengths)
        assert (code.decode(*code.encode(ids), len(ids)) == ids).all()
    # With room enough the code is as short as Huffman's.
    assert token_files.code_lengths(np.array([1, 1, 2, 4]), 18).tolist() == [3, 3, 2, 1]


# 4


def test_licenses(spark, odd, empty):
    notice = licenses.TEMPLATES["MIT-text"]
    half = " ".join(notice.split()[:20])
    rows = [(1, "Some words. " + notice.upper() + " more"), (2, half), (3, "x " * 5000 + "All rights reserved."), (4, None), (5, "")]
    rows += [(3, rows[2][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.license) for r in licenses.op4_licenses(df).collect())
    assert found == [(1, "MIT-text"), (3, "all-rights-reserved"), (3, "all-rights-reserved")]
    assert licenses.op4_licenses(odd).count() == 0 and licenses.op4_licenses(empty).count() == 0


@pytest.mark.parametrize("name", ["op1_topk_nra", "op4_licenses"])
def test_oracle(spark, smoke_dir, name):
    assert differences(queries.QUERIES[name](spark, smoke_dir), connect(smoke_dir), queries.ORACLE[name]) == []


# 5


def test_toxicity(spark, odd, empty):
    rng = random.Random(5)
    bad = ["zorgling", "vextumous", "krabnoid", "plughast"]
    rows, labels = [], []
    for i in range(900):
        text = sentence(rng, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(60), rng.choice(bad) + rng.choice(["", "a", "o,"]))
        rows.append((i, " ".join(text)))
        if i % 9:
            labels.append((i, 0, int(toxic), "extra"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels + [(None, 0, 1, "x"), (5000, 1, None, "x")], "doc_id long, quality int, toxic int, text string")
    found = {r.doc_id: r for r in toxicity.op5_toxicity(docs, known).collect()}
    held = [r for r in found.values() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found.values())
    right = sum(r.predicted == (r.doc_id % 4 == 0) for r in held)
    assert right >= 0.97 * len(held) and sum(r.predicted for r in held if r.doc_id % 4) <= 2
    model = toxicity.fit(docs, known)
    assert toxicity.score(odd, model).count() == len(odd_texts()) and toxicity.score(empty, model).count() == 0
    none = toxicity.op5_toxicity(odd, known.limit(0)).collect()
    assert len(none) == len(odd_texts()) and {(r.score, r.predicted) for r in none} == {(0.0, 0)}


def test_a_long_labelled_text_leaves_the_others_in(spark):
    rng = random.Random(55)
    rows = []
    for i in range(300):
        text = sentence(rng, 40) + (" zorgling vextumous krabnoid" if i % 3 == 0 else "")
        rows.append((i, text, int(i % 3 == 0)))
    frame = spark.createDataFrame([(i,) for i, _, _ in rows], "doc_id long")
    order = {r.doc_id: r.h for r in frame.selectExpr("doc_id", "xxhash64('tox', doc_id) h").collect()}
    known = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    # The row that comes first in each class is longer than the bound.
    first = {min((r for r in known if r[2] == t), key=lambda r: order[r[0]])[0] for t in (0, 1)}
    most = 60_000
    docs = spark.createDataFrame([(i, t + " filler" * 20_000 if i in first else t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, most_bytes=most)
    assert model is not None and b"zorgling" in model.toxic and b"filler" not in model.toxic
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [(scores[i] >= toxicity.THRESHOLD) == (y == 1) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(held) >= 0.97 * len(held)


# 6


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        at = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[at] = "edit"
        elif kind == 1:
            del w[at]
        else:
            w.insert(at, "more")
    return " ".join(w)


def test_decontamination_recall(spark, empty):
    rng = random.Random(6)
    items = [(i, sentence(rng, rng.choice([25, 40, 60]))) for i in range(60)]
    rows = [(n, sentence(rng, 30) + " " + edited(rng, items[n % 60][1], n % 5) + " " + sentence(rng, 30)) for n in range(600)]
    rows += [(1000 + n, sentence(rng, 200)) for n in range(100)] + [(2000, None), (2001, ""), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items + [(100, None), (101, ""), (0, items[0][1]), (102, "unique"), (103, "a bb ccc dddd")], "item_id long, text string")
    found = decontaminate.op6_contamination(docs, bench).collect()
    have = {(r.doc_id, r.item_id) for r in found}
    # At most four edits: within a fifth of the words of any item here.
    planted = {(n, n % 60) for n in range(600)}
    assert len(planted & have) >= 0.97 * len(planted) and {(n, n % 60) for n in range(0, 600, 5)} <= have
    assert not [d for d, _ in have if d >= 1000]
    assert all(r.distance == 0 for r in found if r.doc_id % 5 == 0 and r.item_id == r.doc_id % 60)
    assert sum(r.doc_id == 0 for r in found) == 2
    assert decontaminate.op6_contamination(empty, bench).count() == 0
    assert decontaminate.op6_contamination(docs, bench.limit(0)).count() == 0
    short = spark.createDataFrame([(1, "say unique things"), (2, "x a bb ccc dddd y"), (3, "a bb")], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.op6_contamination(short, bench).collect()) == [(1, 102), (2, 103)]


def test_short_items_with_the_most_edits(spark):
    rng = random.Random(66)
    items, rows = [], []
    for i in range(300):
        n = 16 + i % 5
        w = [f"{rng.choice('abc')}{rng.randrange(3000)}" for _ in range(n)]
        items.append((i, " ".join(w)))
        # Anywhere, spread evenly, and the first and last word among them; floor(n / 5) of each.
        k = n // 5
        at = [rng.sample(range(n), k), [(j + 1) * n // (k + 1) for j in range(k)], [0, n - 1, *rng.sample(range(1, n - 1), k - 2)]][i % 3]
        changed = [f"edit{i}" if p in at else x for p, x in enumerate(w)]
        rows.append((i, " ".join([sentence(rng, 10), *changed, sentence(rng, 10)])))
    # A text that is an item without its first and its last word.
    rows += [(1000 + i, " ".join(items[i][1].split()[1:-1])) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    have = {(r.doc_id, r.item_id): r.distance for r in decontaminate.op6_contamination(docs, bench).collect()}
    for kind in range(3):
        assert sum((i, i) in have for i in range(kind, 300, 3)) >= 98
    assert sum(have.get((1000 + i, i)) == 2 for i in range(50)) >= 49
    assert all(d <= len(items[i][1].split()) // 5 for (_, i), d in have.items())


def test_best_stretch():
    rng = random.Random(8)
    for _ in range(300):
        a = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        b = [rng.randrange(4) for _ in range(rng.randrange(0, 14))]
        row = [0] * (len(b) + 1)
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
            row = new
        assert decontaminate.best_stretch(a, b)[0] == min(row)


# 7


def brute_repeats(rows, window=50):
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeats(spark, odd, empty):
    found = sorted((tuple(r) for r in repeats.op7_repeats(odd).collect()), key=repr)
    assert found == brute_repeats(odd_texts())
    kept = repeats.repeated_passages(odd, texts=True).collect()
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in kept)
    assert repeats.op7_repeats(empty).count() == 0


def test_repeats_in_chains(spark):
    """Pieces of several sources, repeated and shifted, and passages of exactly a window."""
    rng = random.Random(9)
    pool = [sentence(rng, n) for n in (49, 50, 51, 75, 130)]
    rows = [(i, " ".join(rng.choice([*pool, sentence(rng, 7)]) for _ in range(rng.randrange(1, 6)))) for i in range(80)]
    found = repeats.op7_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_repeats(rows)


# 8


def test_language_model(spark, odd, empty):
    rows = odd_texts()
    tokens = [(i, [*words(t, True), "END"], zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2) for i, t in rows]
    counts = Counter(w for _, t, held in tokens if not held for w in t)
    total, kinds = sum(counts.values()), len(counts)
    pairs = Counter(p for _, t, held in tokens if not held for p in zip(t, t[1:]))
    share, left = {}, defaultdict(float)
    for (h, w), n in pairs.items():
        level = math.ceil(-math.log2((n - language_model.DISCOUNT) / counts[h]) * language_model.STEPS - 1e-9)
        if n >= language_model.MIN_PAIRS and level < 255:
            share[h, w] = 2.0 ** (-level / language_model.STEPS)
            left[h] += share[h, w]
    assert all(x <= 1 for x in left.values())
    expected = []
    for i, t, held in tokens:
        alone = [(counts[w] + 1) / (total + kinds + 1) for w in t]
        score = math.log10(alone[0])
        for h, w, p in zip(t, t[1:], alone[1:]):
            rest = math.floor((1 - left[h]) * 65535) / 65535 if h in left else 1.0
            score += math.log10(share.get((h, w), 0.0) + rest * p)
        expected.append((repr(i), held, len(t), sum(counts[w] > 0 for w in t), total, round(sum(map(math.log10, alone)), 5), round(score, 5)))
    found = [(repr(r[0]), *r[1:5], round(r.base_score, 5), round(r.score, 5)) for r in language_model.op8_lm_scores(odd).collect()]
    assert sorted(found) == sorted(expected)
    # Several files for each level give the same scores.
    levels = language_model.train(odd.filter(~language_model.held_out()), per_file=300)
    assert len(levels.words) > 2 and len(levels.pairs) > 1
    again = [(repr(r.doc_id), round(r.score, 5)) for r in language_model.score(odd, levels).collect()]
    assert sorted(again) == sorted((f[0], f[-1]) for f in found)
    assert language_model.op8_lm_scores(empty).count() == 0


# 9


def test_mixing(spark, odd, empty):
    rng = random.Random(10)
    rows = [(i, "w " * rng.randrange(1, 200), f"src{int(rng.random() ** 2 * 7)}" if i % 11 else None) for i in range(3000)]
    df = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, source string")
    found = mixing.op9_source_mix(df).collect()
    assert sorted(map(tuple, found)) == sorted(tuple(r) for r in mixing.op9_source_mix(df.repartition(5)).collect())
    by = defaultdict(lambda: [0, 0, 0.0, 0])
    source = {i: s for i, _, s in rows}
    for r in found:
        x = by[source[r.doc_id]]
        x[0] += r.size
        x[1], x[2] = r.source_size, r.target
        x[3] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    assert all(x[0] == x[1] for x in by.values())
    everything = sum(x[1] for x in by.values())
    assert sum(x[2] for x in by.values()) == pytest.approx(1.5 * everything)
    assert all(abs(x[3] - x[2]) <= max(400, 0.01 * x[2]) for x in by.values())
    # The plain rule: share out, cap, share the excess again.
    names = sorted((s for s in by if s is not None)) + [None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, capped, rest = {}, set(), 1.5 * everything
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names if s not in capped}
        over = {s for s, v in share.items() if v > 2 * by[s][1]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 2.0 * by[s][1]
            rest -= target[s]
        capped |= over
    assert all(by[s][2] == pytest.approx(target[s]) for s in names)
    assert mixing.op9_source_mix(odd).count() == len(odd_texts()) and mixing.op9_source_mix(empty).count() == 0


def test_flight_keeps_totals():
    rng = random.Random(11)
    size = [float(rng.randrange(1, 500)) for _ in range(400)]
    size[100:200] = [50.0] * 100
    flown = mixing.flight([0.3] * 400, size, random.Random(1), False)
    assert sum(0 < q < 1 for q in flown) <= 2
    assert sum(flown) == pytest.approx(120) and sum(q * s for q, s in zip(flown, size)) == pytest.approx(0.3 * sum(size))


# 10


def brute_components(rows):
    sets = []
    for i, t in rows:
        w = words(t, True)
        sets.append((i, frozenset(tuple(w[p : p + 3]) for p in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 90 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return sorted(((i, len(s), least.get(find(a)) if s else i) for a, (i, s) in enumerate(sets)), key=repr)


def test_jaccard(spark, odd, empty):
    found = sorted((tuple(r) for r in jaccard.op10_jaccard(odd).collect()), key=repr)
    assert found == brute_components(odd_texts())
    assert jaccard.op10_jaccard(empty).count() == 0


def test_jaccard_in_hot_groups(spark, monkeypatch):
    """Near copies of one text in a group that is dealt into blocks."""
    monkeypatch.setattr(jaccard, "SMALL", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(12)
    base = sentence(rng, 100)
    rows = [(i, edited(rng, base, rng.choice([0, 1, 2, 3, 4, 5, 9]))) for i in range(120)]
    rows += [(200 + i, sentence(rng, rng.randrange(1, 60))) for i in range(60)]
    found = jaccard.op10_jaccard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_components(rows)


def test_jaccard_divides_hot_groups(spark, monkeypatch):
    """Blocks of few rows and columns; families that share a hot token under one order and none under another."""
    for name, value in (("SMALL", 4), ("BLOCK", 8), ("COLUMNS", 5)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(5)
    rows = []
    for family in range(12):
        base = sentence(rng, 60)
        rows += [(100 * family + i, edited(rng, base, rng.choice([0, 1, 2, 3, 6])) + " the same last words") for i in range(15)]
    # One frequency level for all tokens: prefixes hold frequent tokens too.
    monkeypatch.setattr(jaccard, "token_levels", lambda docs, k: np.zeros(1 << 12, np.uint8))
    found = jaccard.op10_jaccard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_components(rows)


def test_jaccard_of_many_near_copies(spark):
    """More near copies than a block holds, most of them close to the limit."""
    rng = random.Random(8)
    base = sentence(rng, 90)
    rows = [(i, edited(rng, base, rng.choice([1, 2, 3, 4]))) for i in range(1200)]
    found = jaccard.op10_jaccard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_components(rows)


def test_a_hot_group_is_divided_by_further_orders(spark, monkeypatch):
    """Nodes that share a prefix token under every order still meet, and less is read than without dividing."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    sets = [(i, 50, [i % 6, 100 + i % 3], [i % 6 + (i % 12 >= 6) * 50]) for i in range(48)]
    members = spark.createDataFrame([(1, i, n, i) for i, n, _, _ in sets], "key long, node long, n long, root long")
    groups = jaccard.stored(jaccard.open_groups(members), "test-groups")
    met = jaccard.together(groups, spark.createDataFrame(sets, "node long, n long, other1 array<int>, other2 array<int>")).collect()
    assert met and 1 not in {r["key"] for r in met}
    tasks = defaultdict(list)
    for r in met:
        tasks[r["key"], r["_i"], r["_j"]].append((r["node"], r["_block"]))
    pairs = {
        (a, b) for (_, i, j), rows in tasks.items() for a, x in rows for b, y in rows if a < b and (i == j or x != y)
    }
    wanted = {(a[0], b[0]) for a in sets for b in sets if a[0] < b[0] and set(a[2]) & set(b[2]) and set(a[3]) & set(b[3])}
    assert wanted <= pairs and len(pairs) < 48 * 47 / 2


def test_a_task_holds_few_files_of_the_model(spark):
    """Mapped files are let go of while others are read, and what a task has counted goes out in small batches."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices([f"w{x}" for x in range(60)], k=40))) for i in range(200)]
    levels = language_model.train(spark.createDataFrame(rows, "doc_id long, text string"), per_file=100)
    assert len(levels.pairs) > language_model.HELD_MAPPED
    words, pairs = language_model.Words(levels, True), language_model.Pairs(levels)
    keys = (np.repeat(np.arange(levels.distinct), levels.distinct) << 32) | np.tile(np.arange(levels.distinct), levels.distinct)
    found = pairs.find(keys)
    assert len(pairs.files) == language_model.HELD_MAPPED and len(words.files) <= language_model.HELD_MAPPED
    said = [[*t.split(), "end"] for _, t in rows]
    assert (found > 0).sum() == len({pair for w in said for pair in zip(w, w[1:])})
    sequence = pairs.file(0)[2]
    assert np.shares_memory(sequence.ones, sequence.ones.base) and (sequence.ones[-1], sequence.zeros[0]) == (sequence.n, 0)
    batches = list(language_model.counted(iter([np.arange(250_000, dtype=np.uint64)]), np.int64))
    assert [b.num_rows for b in batches] == [100_000, 100_000, 50_000]


def test_dividing_a_hot_group_reads_shared_tokens_only(spark, monkeypatch):
    """A member meets its prefix as one row, and tokens that nobody shares are not taken apart; every pair still meets."""
    kept = {}

    def watched(df, name):
        kept.setdefault(name, []).append(df := stored(df, name))
        return df

    stored = jaccard.stored
    monkeypatch.setattr(jaccard, "stored", watched)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    sets = [(i, 50, [i % 12, *range(1000 + 20 * i, 1020 + 20 * i)], [i % 12, -5 - i]) for i in range(48)]
    members = spark.createDataFrame([(1, i, n, i) for i, n, _, _ in sets], "key long, node long, n long, root long")
    given = spark.createDataFrame(sets, "node long, n long, other1 array<int>, other2 array<int>")
    met = jaccard.together(stored(jaccard.open_groups(members), "test-groups"), given).collect()
    assert {(r["node"] % 12) for r in met} == set(range(12)) and len({r["key"] for r in met}) == 12
    assert kept["jaccard-tokens"][0].count() == 48
    assert [sorted(r.tokens) for r in jaccard.shared_lists(given.selectExpr("node", "other1 AS tokens")).orderBy("node").collect()] == [[i % 12] for i in range(48)]
    assert jaccard.shared_lists(given.limit(0).selectExpr("node", "other1 AS tokens")).count() == 0


def test_a_forest_ties_what_is_linked():
    rng = np.random.default_rng(3)
    tokens = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
    sets = [np.sort(rng.choice(tokens, rng.integers(60, 64), replace=False)) for _ in range(20)]
    sets += [np.sort(np.concatenate([s[:-1], tokens[:1]])) if tokens[0] not in s else s for s in sets]
    counts = jaccard.shared_counts(sets)
    assert all(counts[a, b] == len(np.intersect1d(x, y)) for a, x in enumerate(sets) for b, y in enumerate(sets))
    rows = pd.DataFrame({"tokens": [s.tobytes() for s in sets], "node": range(40), "root": range(40), "_block": 0, "_i": 0, "_j": 0})
    links = jaccard.forest(90)(rows)
    assert len(links) < 40 and {(i, i + 20) for i in range(20)} <= set(map(tuple, links.values.tolist()))


def test_queries_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLE) <= set(queries.QUERIES)
    assert "corpus_pipeline" in sys.modules or __import__("corpus_pipeline").STAGES


def test_pairs_that_occur_once_are_held(spark):
    """Of two texts of the same words, the one whose pairs were met once is likelier."""
    met = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40)))], "doc_id long, text string")
    levels = language_model.train(met)
    asked = spark.createDataFrame([(1, "w3 w4 w5 w6"), (2, "w6 w4 w3 w5")], "doc_id long, text string")
    found = {r.doc_id: r for r in language_model.score(asked, levels).collect()}
    assert abs(found[1].base_score - found[2].base_score) < 1e-9
    assert found[1].score > found[2].score + 1
