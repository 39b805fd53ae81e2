import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.llm import language_id, packing, site_style, subword_sampling, threshold_search, tokens, toxicity

from .conftest import sentence

# --- toxicity ----------------------------------------------------------------------------------------------------------


def toxic_rows(n=400):
    r = random.Random(8)
    rows = []
    for k in range(n):
        toxic = k % 5 == 0
        w = sentence(r, 40).split()
        if toxic:
            for x in ("zzvile", "qqfoul" + r.choice("abc")):
                w.insert(r.randrange(len(w)), x)
        rows.append((k, " ".join(w), int(toxic)))
    return rows


def test_toxicity_finds_marked_documents(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows if d % 3], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(out) == len(rows)
    assert all(out[d].predicted == y and 0 <= out[d].score <= 1 for d, _, y in rows)
    assert all(out[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, _, _ in rows)
    assert all(e.doc_id % 3 and zlib.crc32(str(e.doc_id).encode()) % 5 for r in out.values() for e in r.evidence)


def test_all_examples_and_words_are_in_the_index(spark):
    docs = spark.createDataFrame([(1, "calm words here"), (2, "vile words here"), (3, "calm river")], "doc_id long, text string")
    index = toxicity.fit(docs, spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "doc_id long, toxic int"))
    assert len(index.terms) == 5 and sorted(index.ids.tolist()) == [1, 2, 3]


def test_scores_ignore_ids_and_other_columns(spark):
    """Other ids and another order, at the fit too, give the same scores."""
    rows = toxic_rows(200)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    other = docs.withColumn("doc_id", F.col("doc_id") * -17).withColumn("lang", F.lit("x")).repartition(3)
    a = toxicity.score(docs, toxicity.fit(docs, labels)).select("text", "score").collect()
    b = toxicity.score(other, toxicity.fit(other, labels.withColumn("doc_id", F.col("doc_id") * -17))).select("text", "score").collect()
    assert Counter(map(tuple, a)) == Counter(map(tuple, b))


def test_block_max_search_is_exact():
    r = np.random.default_rng(3)
    terms = np.sort(r.integers(0, 1 << 62, 40).astype(np.uint64))
    bags = [np.sort(r.choice(40, r.integers(1, 6), replace=False)) for _ in range(500)]
    example, term = np.repeat(np.arange(500), [len(t) for t in bags]), np.concatenate(bags)
    count, weight, labels = r.integers(1, 4, len(term)), r.random(40) + 1, r.integers(0, 2, 500)
    index = toxicity._index(terms, weight, np.arange(500), labels, {0: 1.0, 1: 1.0}, example, term, count, 15)
    plain = np.zeros((500, 40))
    plain[example, term] = (1 + np.log(count)) * weight[term]
    dense = (plain / np.sqrt((plain**2).sum(1, keepdims=True)))[index.ids]
    assert (index.labels == labels[index.ids]).all()
    for _ in range(50):
        t = np.sort(r.choice(40, 4, replace=False))
        w = index.vector(t, r.integers(1, 3, 4))
        row, cosine = index.nearest(t, w)
        score = dense[:, t] @ w
        best = np.lexsort((np.arange(500), -np.round(score, 9)))[:15]
        assert row.tolist() == best.tolist() and np.allclose(cosine, score[best])


def brute_toxicity(rows, labels, k=15):
    """Scores of (id, text) by plain dictionaries and a scan of all examples."""
    bags = [Counter(re.findall(r"(?:[a-z]|[^\x00-\x7f])+", (t or "").lower())) for _, t in rows]
    seen, examples = set(), []
    for (d, t), bag in zip(rows, bags):
        if d in labels and zlib.crc32(str(d).encode()) % 5 and t is not None and (t, labels[d]) not in seen:
            seen.add((t, labels[d]))
            examples.append((bag, labels[d]))
    n1, n0 = sum(y for _, y in examples), sum(1 - y for _, y in examples)
    odds = n1 / (n1 + n0)
    whole = Counter(w for b in bags for w in b)
    marks = [Counter(w for b, y in examples if y == c for w in b) for c in (0, 1)]
    def relevance(toxic, clean):
        """Squared log odds, less where they are unsure: a word's z-score against 3."""
        t, c = toxic + 5 * odds, clean + 5 * (1 - odds)
        lift = math.log(t / c / (odds / (1 - odds)))
        z = lift * lift / (1 / t + 1 / c)
        return lift * lift * z / (z + 3)

    weight = {w: (math.log((1 + len(rows)) / (1 + whole[w])) + 1) * relevance(marks[1][w], marks[0][w]) for w in marks[0] + marks[1]}

    def vector(bag):
        v = {w: (1 + math.log(c)) * weight[w] for w, c in bag.items() if w in weight}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if norm else {}

    vectors = [vector(b) for b, _ in examples]

    def vote(v, skip=None):
        cosines = sorted(((sum(x * e[w] for w, x in v.items() if w in e), y) for j, (e, (_, y)) in enumerate(zip(vectors, examples)) if j != skip), key=lambda c: -c[0])
        near = [(c, y) for c, y in cosines[:k] if c > 0]
        prior = odds  # no example is without terms here
        w = [1 / (0.05 + max(0, 1 - c)) - 1 / 1.05 for c, _ in near]
        return (sum(a * y for a, (_, y) in zip(w, near)) + prior) / (sum(w) + 1) if near else prior

    curve = toxicity.isotonic(np.array([vote(v, j) for j, v in enumerate(vectors)]), np.array([y for _, y in examples], float), np.ones(len(examples)))
    return [float(np.interp(vote(v), *curve)) if (v := vector(b)) else odds for b in bags]


def test_toxicity_equals_brute_force(spark):
    rows = [r[:2] for r in toxic_rows(150)]
    labels = {d: y for d, _, y in toxic_rows(150) if d % 3}
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    out = {r.doc_id: r.score for r in toxicity.toxicity(docs, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")).collect()}
    want = brute_toxicity([*rows, (900, None), (901, "")], labels)
    assert [round(out[d], 6) for d, _ in rows] + [out[900], out[901]] == pytest.approx(want, abs=1e-6)


def test_isotonic():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0, 1, 0, 1.0]), np.ones(4))
    assert np.all(np.diff(y) >= 0) and abs(np.interp(0.25, x, y) - 1.5 / 4) < 1e-9


def test_toxicity_odd(spark, odd_docs, no_docs, odd_rows):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (None, 1), (4, None), (9, 0), (10, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity(odd_docs, labels).collect()
    assert len(out) == len(odd_rows) and all(r.score is not None and 0 <= r.score <= 1 for r in out)
    assert toxicity.toxicity(no_docs, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(odd_docs, labels.limit(0)).collect()} == {0.0}


# --- language ----------------------------------------------------------------------------------------------------------


def language_rows():
    r = random.Random(2)
    words = {"aa": ["thin", "wick", "shout", "then"], "bb": ["über", "straße", "ich", "nicht"], "cc": ["mañana", "ción", "que", "llar"]}
    return [(k, " ".join(r.choice(words[g]) for _ in range(r.choice([5, 40, 200]))), g) for k in range(240) for g in [list(words)[k % 3]]]


def test_language(spark):
    rows = language_rows()
    docs = spark.createDataFrame([(d, t, g if d % 4 else None) for d, t, g in rows], "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language_id.language(docs).collect()}
    assert np.mean([out[d].lang_pred == g for d, _, g in rows]) > 0.97
    assert all(out[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= out[d].score <= 1 for d, _, _ in rows)


def plain_probabilities(p, widths, window):
    """The network's probabilities of one window, position by position, in plain sums."""
    pooled = []
    for w in widths:
        for f in range(p[f"W{w}"].shape[1]):
            at = [sum(float(p["E"][window[i + j]][d]) * float(p[f"W{w}"][j * p["E"].shape[1] + d][f]) for j in range(w) for d in range(p["E"].shape[1])) for i in range(len(window) - w + 1)]
            pooled.append(max(0.0, max(at) + float(p[f"c{w}"][f])))
    z = [sum(v * float(p["U"][k][c]) for k, v in enumerate(pooled)) + float(p["b"][c]) for c in range(len(p["b"]))]
    e = [math.exp(v - max(z)) for v in z]
    return [v / sum(e) for v in e]


def test_network_learns():
    net = language_id.ByteCNN(["a", "b"], filters=3, size=2)
    x = np.random.default_rng(1).integers(0, 256, (40, 32)).astype(np.uint8)
    y = (x[:, 3] > 128).astype(int)
    x[:, 3:6] = np.where(y[:, None] == 1, 250, 3)
    net.train(x, y, steps=200)
    assert (net.probabilities(x).argmax(1) == y).mean() > 0.95
    assert np.allclose(net.probabilities(x).sum(1), 1, atol=1e-5)


def test_network_gradients_equal_differences():
    net = language_id.ByteCNN(["a", "b", "c"], filters=3, size=2)
    r = np.random.default_rng(2)
    net.p = {k: r.normal(0, 0.7, v.shape) for k, v in net.p.items()}  # doubles, so that differences are sharp
    x, y = r.integers(0, 6, (5, 9)).astype(np.uint8), np.array([0, 1, 2, 1, 0])

    def loss():
        return -np.log(net.probabilities(x)[np.arange(5), y]).mean()

    for name, g in net.gradients(x, y).items():
        for at in [tuple(r.integers(0, n) for n in g.shape) for _ in range(12)] + ([(int(x[0, 0]), 0), (int(x[1, 3]), 1)] if name == "E" else []):
            was, step = net.p[name][at], 1e-6
            net.p[name][at] = was + step
            up = loss()
            net.p[name][at] = was - step
            down = loss()
            net.p[name][at] = was
            assert g[at] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_inference_equals_plain_sums(spark):
    """Whole texts of one and of several windows: the mean over windows by their bytes, against the plain network."""
    net = language_id.ByteCNN(["x", "y", "z"], filters=2, size=3)
    r = random.Random(4)
    texts = ["a", "é" * 130, "".join(r.choice("abc déf 漢") for _ in range(700)), "b" * language_id.WINDOW]
    got = language_id.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), net).orderBy("doc_id").collect()
    for text, row in zip(texts, got):
        data = text.encode()
        parts = [data[a : a + language_id.WINDOW] for a in range(0, len(data), language_id.WINDOW)]
        p = [plain_probabilities(net.p, net.widths, part.ljust(language_id.WINDOW, b"\0")) for part in parts]
        mean = [sum(q[c] * len(part) for q, part in zip(p, parts)) / len(data) for c in range(3)]
        assert row.lang_pred == net.classes[int(np.argmax(mean))] and row.score == pytest.approx(max(mean), abs=1e-5)


def test_numbers_are_no_letters(spark):
    rows = [(k, "plain words here", "en") for k in range(8)] + [(10, "½", None), (11, "²", None), (12, "①", None), (13, "Ⅷ", None), (14, "½a", None), (15, "漢", None), (16, "_1", None)]
    out = {r.doc_id: r.lang_pred for r in language_id.language(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [out[k] for k in range(10, 17)] == ["und"] * 4 + ["en", "en", "und"]


def test_windows_cover_whole_texts():
    for n in (0, 1, 255, 256, 257, 1000):
        data = bytes(range(1, 256)) * 5
        w = language_id.windows(data[:n])
        assert w.shape[1] == language_id.WINDOW and w.tobytes().rstrip(b"\0") == data[:n].rstrip(b"\0")


def test_language_odd(odd_docs, odd_rows, no_docs):
    out = language_id.language(odd_docs).collect()
    assert len(out) == len(odd_rows)
    und = Counter(r.lang_pred == "und" for r in out if not any(c.isalpha() for c in r.text or ""))
    assert set(und) == {True} and all(r.lang_pred != "und" for r in out if any(c.isalpha() for c in r.text or ""))
    assert language_id.language(no_docs).count() == 0


def test_products_beyond_doubles(spark):
    """Finite components whose products with the scale are not: scores are exact and ranked, and shown as the nearest long."""
    rows = [(0, [1e308, 1.0]), (1, [1e308, 2.0]), (2, [-1e308, 0.0]), (3, [1.5, -0.25]), (4, [1e300, 1e300]), (10, [-2.0, 1e-310])]
    found = threshold_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, 3).collect()
    whole = {i: [(Fraction(x) * 1024).__floor__() for x in v] for i, v in rows}
    shown = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    for q in (0, 10):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)[:3]
        assert sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q) == [(k + 1, i, shown(-s)) for k, (s, i) in enumerate(best)]


# --- tokens and packing ------------------------------------------------------------------------------------------------


def test_ids_equal_the_tokenizer(odd_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(0)
    alphabet = "ab's'tre 'llve\n\t  '''dm12²½é漢🙂  !?.\x1c 　"
    texts = [t or "" for _, t, *_ in odd_rows] + ["<|endoftext|>", "hello <|endoftext|> world", "a<|endoftext|><|endoftext|>  b<|endoftext", "it's we'll I'VE 'sun"] + ["".join(r.choice(alphabet) for _ in range(r.randrange(40))) for _ in range(3000)]
    of = tokens.batch_tokenizer(packing.vocabulary())
    got = [x for a, b in tokens.in_groups(texts, 5000) for x in of.ids(texts[a:b])]
    assert [x.tolist() for x in got] == [e.ids for e in known.encode_batch(texts, add_special_tokens=False)]


def thue_morse(n):
    return "".join("ab"[k.bit_count() % 2] for k in range(n))


def test_pieces_that_share_a_hash():
    """Two words of one polynomial hash; the ids must still be those of their contents."""
    import public_tokenizers
    from tokenizers import Tokenizer

    one = thue_morse(4096)
    two = one.translate(str.maketrans("ab", "ba"))
    cp = np.frombuffer((one + two).encode("utf-32-le"), np.uint32)
    starts, ends = np.array([0, 4096]), np.array([4096, 8192])
    assert len(set(tokens.point_hashes(cp, starts, ends).tolist())) == 1
    assert tokens._distinct(cp, starts, ends)[0].tolist() == [0, 1]
    text = f"{one} {two} {one} x {two}"
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokens.batch_tokenizer(packing.vocabulary()).ids([text])[0].tolist() == known.encode(text, add_special_tokens=False).ids


def test_known_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "_MAX_KNOWN", 10)
    of = tokens.BatchTokenizer(packing.vocabulary())
    whole = of.ids(["many different words in one text here and there"])[0].tolist()
    assert of.ids(["x"])[0].tolist() and of.ids(["many different words in one text here and there"])[0].tolist() == whole


def check_places(rows, most):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= most
    return len(by)


def test_plan_is_best_fit():
    r = random.Random(4)
    for _ in range(30):
        most = r.choice([8, 64, 1024])
        counts = {r.randint(1, most): r.randint(1, 50) for _ in range(r.randint(1, 60))}
        runs = packing.plan(counts, most)
        used, seen = Counter(), Counter()
        for length, rank, n, first, offset in sorted(runs, key=lambda x: x[4]):
            seen[length] += n
            for s in range(first, first + n):
                assert used[s] == offset
                used[s] += length
        assert seen == Counter(counts) and max(used.values()) <= most
        items = sorted((k for k, n in counts.items() for _ in range(n)), reverse=True)
        bins = []  # best fit, one at a time
        for x in items:
            fit = [b for b in bins if b[0] >= x]
            if fit:
                min(fit, key=lambda b: b[0])[0] -= x
            else:
                bins.append([most - x])
        assert len(used) == len(bins)


def test_packing(odd_docs, odd_rows, no_docs):
    rows = packing.pack_documents(odd_docs).collect()
    from tokenizers import Tokenizer

    of = Tokenizer.from_file(packing.vocabulary())
    want = Counter()
    for d, t, *_ in odd_rows:
        ids = np.append(of.encode(t or "", add_special_tokens=False).ids, 2).astype("<u4")
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = check_places(rows, 1024)
    assert sequences <= 1.1 * sum(r.length for r in rows) / 1024 + 1
    assert packing.pack_documents(no_docs).count() == 0


# --- top k -------------------------------------------------------------------------------------------------------------


def brute_top(rows, k):
    units = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q in {i for i, _ in units if i % 10 == 0}:
        s = sorted((-sum(a * b for a, b in zip(x, y)), i) for j, x in units if j == q for i, y in units if i != q)
        out.update({(q, r): (i, -v) for r, (v, i) in enumerate(s[:k], 1)})
    return out


@pytest.mark.parametrize("block,chunk", [(8192, 1024), (30, 3)])
def test_top_k(spark, block, chunk):
    r = random.Random(7)
    rows = [(k, [r.choice([-1.0, 0.0, 0.5, r.uniform(-1, 1)]) for _ in range(6)]) for k in range(150)]
    rows += [(200 + k, rows[3][1]) for k in range(25)] + [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (310, [float("inf")] * 6), (320, [0.0] * 6), (None, [1.0] * 6)]
    rows += [(20, rows[21][1]), (20, rows[3][1])] + [(7, rows[3][1])] * 15 + [(150, rows[3][1])] * 15 + [(151, [1.0, -1.0])]  # repeated ids, an uneven length
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"score": F.lit(1), "block": F.lit(2), "chunk": F.lit(3), "rank": F.lit(4)})
    got = {(x.query_id, x.rank): (x.vec_id, x.score) for x in threshold_search.top_k(df, F.col("vec_id") % 10 == 0, 10, block=block, chunk=chunk).collect()}
    floats = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == brute_top(floats, 10)


def test_top_k_large_components(spark):
    """Products beyond 53 and beyond 64 bits: ranked exactly, shown as the nearest long."""
    rows = [(0, [100000.0, 0.0]), (1, [100000.0, 1.0]), (2, [70000.0, 0.0]), (3, [-100000.0, 5.0]), (10, [1e30, 0.0]), (4, [1e30, 0.0]), (5, [2e30, 0.0]), (6, [-1e30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(x.query_id, x.rank): (x.vec_id, x.score) for x in threshold_search.top_k(df, F.col("vec_id") % 10 == 0).collect()}
    clipped = {q: (i, max(-(2**63), min(2**63 - 1, s))) for q, (i, s) in brute_top(rows, 10).items()}
    assert got == clipped and got[10, 1][0] == 5 and 10485760000000000 in {s for _, s in got.values()}


def test_top_k_stops_early():
    v = np.zeros((4000, 8))
    v[:, 0] = np.arange(4000)
    lists = threshold_search.Lists(np.arange(4000), v, 10)
    assert [i for _, i in lists.top(np.array([1.0, 0, 0, 0, 0, 0, 0, 0]), -1, 10)] == list(range(3999, 3989, -1)) and lists.read < 100


def test_top_k_small(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert threshold_search.top_k(empty, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert threshold_search.top_k(one, F.col("vec_id") % 10 == 0).count() == 0


# --- pages -------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "page,want",
    [
        ("<p>a <b>b</b><br>c<p>d &amp; &eacute;&nbsp;e", ["a b c", "d & é e"]),
        ("<nav><ul><li>x</ul></nav><article><header><h1>T</h1></header><p>one</p><div class='share-buttons'>s</div><section id='comments'><p>no</p></section></article><footer>f</footer>", ["T", "one"]),
        ("<script>var a='</p><p>';</script><style>p{}</style><p>x</p><!-- <p>no</p> --><form><p>f</p></form><aside>a</aside>", ["x"]),
        ("<ul><li>1<li>2<ul><li>3</ul></ul><table><tr><td>a<td>b<tr><td>c</table>", ["1", "2", "3", "a b", "c"]),
        ("<div class=ad>no</div><div class='headline'>yes</div><p hidden>no<p style='display: none'>no</p>< 3", ["yes", "< 3"]),
        ("<article><section class='related-work'><p>a</p></section><p class='notice-of-motion'>b</p><div class='header-note'>c</div><div class='ad-slot-3 x'>no</div><div class='related'>no</div></article>", ["a", "b", "c"]),
        ("plain text", ["plain text"]),
        ("<p>unclosed <a href='x", ["unclosed"]),
        ("", []),
    ],
)
def test_blocks(page, want):
    assert site_style.blocks(site_style.parse(page), set()) == want


def test_noise_ends_at_any_depth():
    deep = 5000
    page = "<body><article><p>Start.</p><div class='sidebar'>" + "<div>" * deep + "buy" + "</div>" * deep + "more to buy</div><p>End.</p></article></body>"
    assert [t for b in site_style.blocks(site_style.parse(page), set()) if (t := "".join(b).strip())] == ["Start.", "End."]
    page = "<body>" + "<div>" * deep + "<nav>skip</nav><p>Kept.</p>" + "</div>" * deep + "</body>"
    assert [t for b in site_style.blocks(site_style.parse(page), set()) if (t := "".join(b).strip())] == ["Kept."]
    node = site_style.parse(page)
    while node.items and isinstance(node.items[0], site_style.Node):
        node = node.items[0]
        assert len(node.path) < 2000


def test_style_tree_finds_noise_without_names(spark):
    """A strip that every page of a site repeats, in an element that says nothing about itself."""
    r = random.Random(1)
    page = lambda k: f"<html><body><div class='x1'><p>Home of things</p><p>Call us today</p></div><div class='x2'><h1>{sentence(r, 4)}</h1><p>{sentence(r, 30)}</p><p>{sentence(r, 20)}</p></div></body></html>"
    rows = [(k, f"https://one.org/{k}", page(k)) for k in range(12)] + [(50, "https://two.org/", page(50)), (60, None, None), (61, "not a url", ""), (62, "https://one.org/0", "<p>alone</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("old"), "host": F.lit("h"), "low": F.lit("l")})
    out = {x.page_id: x for x in site_style.main_text(df).collect()}
    assert all("Home of things" not in out[k].text and len(out[k].text.split("\n\n")) == 3 for k in range(12))
    assert "Home of things" in out[50].text  # one page is no evidence
    assert (out[60].text, out[60].n_chars, out[61].text, out[62].text) == ("", 0, "", "alone")
    assert out[3].n_chars == len(out[3].text) and out[3].host == "h"


def strips_page(r, k):
    """Strips that hold new words on every page, in elements that say nothing about themselves."""
    return f"<html><body><div class='q1'><ul><li>{sentence(r, 1)}</li><li>{sentence(r, 1)}</li></ul></div><div class='q2'>{sentence(r, 6)}</div><div class='q3'><h1>{sentence(r, 5)}</h1>" + "".join(f"<p>{sentence(r, r.randint(5, 60))}</p>" for _ in range(r.randint(2, 5))) + f"</div><div class='q4'>by {sentence(r, 4)}</div></body></html>"


def test_the_tree_alone_removes_strips_with_new_words(spark):
    r = random.Random(3)
    rows = [(k, f"https://one.org/{k}", strips_page(r, k)) for k in range(20)]
    out = site_style.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), names=False).collect()
    for x in out:
        q3 = re.search(r"<div class='q3'>(.*?)</div>", x.html).group(1)
        assert x.text.split("\n\n") == re.findall(r"<(?:h1|p)>(.*?)</", q3)


def brute_importance(pages):
    """Importance by path, from whole trees in memory; text entropies over pages by their definition."""
    seen, styles, texts, info = {}, {}, {}, {}
    for k, page in enumerate(pages):
        work = [(site_style.parse(page), "")]
        while work:
            node, parent = work.pop()
            if node.empty:
                continue
            inner = [x for x in node.items if not isinstance(x, str)]
            seen.setdefault(node.path, set()).add(k)
            info[node.path] = (parent, node.tag, node.main)
            styles.setdefault(node.path, Counter())[k, ">".join(dict.fromkeys(x.style for x in inner))] = 1
            for t in (" ".join(x.split()) for x in node.items if isinstance(x, str) and x.strip()):
                texts.setdefault(node.path, {}).setdefault(t, Counter())[k] += 1
            work += [(x, node.path) for x in inner]
    seen = {p: ks for p, ks in seen.items() if len(ks) >= site_style.MIN_PAGES}
    entropy = lambda counts, base: -sum(c / sum(counts) * math.log(c / sum(counts), base) for c in counts)
    mass, news = {}, {}

    def add(p, top):
        words = sum(len(t.split()) * sum(c.values()) for t, c in texts.get(p, {}).items())
        fresh = words - sum(len(t.split()) * sum(c.values()) * entropy(list(c.values()), len(seen[p])) for t, c in texts.get(p, {}).items())
        for q in seen:
            if q != p and info[q][0] == p and q:
                a, b = add(q, top)
                words, fresh = words + a, fresh + b
        mass[p], news[p] = words, max(0, fresh)
        return words, fresh

    for p in seen:
        add(p, p)
    out = {}
    for p in seen:
        parent, tag, main = info[p]
        content = min(1, news[p] / mass[p]) if mass[p] else 0
        value = content
        if tag in site_style.PARTS and not main:
            kinds = Counter(x for _, x in styles[p])
            best = max(news[q] for q in seen if q and info[q][0] == parent)
            share = min(1, news[p] / max(best, 1e-9) / site_style.SHARE)
            value = content * (1 - (1 - share) * (1 - min(1, entropy(list(kinds.values()), len(seen[p])))))
        out[p] = value
    return out


def test_importance_equals_brute_force(spark):
    r = random.Random(4)
    pages = [strips_page(r, k) for k in range(9)] + ["<body><div class='q2'>same words</div><article><div>x</div></article></body>" + "<!-- %d -->" % k for k in range(5)]
    rows = [(k, "https://one.org/", p) for k, p in enumerate(pages)] + [(99, "https://two.org/", pages[0])]
    tree = site_style.style_tree(spark.createDataFrame(rows, "page_id long, url string, html string"), "url", "html").collect()
    want = brute_importance(pages)
    assert {x.host for x in tree} == {"one.org"} and {x.path: x.importance for x in tree} == pytest.approx(want, abs=1e-9)


def test_deep_pages_have_a_tree(spark):
    page = lambda k: "<body>" + "<div>" * 400 + f"<p>article number {k} at the bottom</p>" + "</div>" * 400 + "</body>"
    rows = [(k, "https://one.org/", page(k)) for k in range(6)] + [(0, "https://one.org/", page(0))]
    out = site_style.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert Counter((x.page_id, x.text) for x in out) == Counter((k, f"article number {k} at the bottom") for k, *_ in rows)


def test_copies_of_one_page_keep_their_text(spark):
    rows = [(k, "https://one.org/a", "<body><div><p>the very same text</p></div></body>") for k in range(20)]
    out = site_style.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == 20 and {x.text for x in out} == {"the very same text"}


def test_no_pages(spark):
    assert site_style.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- segmentations -----------------------------------------------------------------------------------------------------


def all_segmentations(arcs, at=0):
    if at == len(arcs):
        yield 0.0, ()
    else:
        for n, w, ids in arcs[at]:
            for rest, tail in all_segmentations(arcs, at + n):
                yield w + rest, ids + tail


@pytest.fixture(scope="module")
def of():
    return subword_sampling.pieces(subword_sampling.model_path())


def test_decoding(of, odd_rows):
    for _, t, *_ in odd_rows:
        t = (t or "")[:3000]
        for found in (of.encode(t), *(ids for _, _, ids in subword_sampling.sample(of.arcs(of.prepared(t)), 2, 1)[0])):
            assert of.decode(found) == t == of.model.decode(found)


def test_samples_without_replacement(of):
    arcs = of.arcs(of.prepared("thenab"))
    every = list(all_segmentations(arcs))
    whole = math.log(sum(math.exp(w) for w, _ in every))
    assert abs(subword_sampling.masses(arcs)[0] - whole) < 1e-9
    p = {ids: math.exp(w - whole) for w, ids in every}
    first, second, n = Counter(), Counter(), 4000
    for seed in range(n):
        found, last = subword_sampling.sample(arcs, 2, seed * 7919)
        assert found[0][0] >= found[1][0] >= last and found[0][2] != found[1][2]
        first[tuple(found[0][2])] += 1
        second[tuple(found[1][2])] += 1
    for ids in sorted(p, key=p.get, reverse=True)[:4]:
        want = sum(p[a] * p[ids] / (1 - p[a]) for a in p if a != ids)
        assert abs(first[ids] / n - p[ids]) < 0.04 and abs(second[ids] / n - want) < 0.04
    found, last = subword_sampling.sample(arcs, len(every) + 5, 3)
    assert {tuple(f[2]) for f in found} == set(p) and last == -math.inf


def test_inclusion_weights_are_unbiased(of):
    arcs = of.arcs(of.prepared("then"))
    total, n = 0.0, 3000
    for seed in range(n):
        found, last = subword_sampling.sample(arcs, 2, seed * 31 + 5)
        total += sum(math.exp(lp) / subword_sampling.inclusion(lp, last) for _, lp, _ in found)
    assert abs(total / n - 1) < 0.05


def test_a_lossy_round_trip_is_told(spark):
    df = spark.createDataFrame([(1, "a\u2581b"), (2, "a b")], "doc_id long, text string")
    out = subword_sampling.sampled_segmentations(df, ["doc_id"], k=2).collect()
    assert {(r.doc_id, r.round_trip) for r in out} == {(1, False), (2, True)}


def test_sampling_odd(odd_docs, odd_rows, no_docs):
    small = odd_docs.where("text is null or length(text) < 5000")
    a = subword_sampling.sampled_segmentations(small, ["doc_id", "source"], k=2)
    rows = a.collect()
    assert Counter(r.doc_id for r in rows if r.sample == 1) == Counter(d for d, t, *_ in odd_rows if len(t or "") < 5000)
    assert all(r.round_trip and 0 <= r.inclusion <= 1 for r in rows) and "text" not in a.columns
    again = subword_sampling.sampled_segmentations(small.repartition(5), ["doc_id", "source"], k=2).collect()
    key = lambda rs: Counter((r.doc_id, r.sample, tuple(r.ids)) for r in rs)
    assert key(rows) == key(again)
    assert subword_sampling.sampled_segmentations(no_docs, ["doc_id"]).count() == 0
