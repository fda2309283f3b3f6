"""What SQL cannot express, against a plain version, held-out labels or known truth."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexiloom.llm import decontaminate, html, language, near_dedup, outliers, quality, queries, secrets, toxicity
from lexiloom.llm.calibration import pool_violators
from lexiloom.llm.lstm import BlockLabeller
from lexiloom.llm.statistics import count_all
from tests.llm.conftest import SF

PLAIN = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def test_base_counts(texts):
    found = count_all(pa.array(list(texts.values())))
    for text, row in zip(texts.values(), found):
        words = PLAIN.findall(text)
        lines = [line for line in text.split("\n") if PLAIN.search(line)]
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        hit = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        assert row[:6].tolist() == [len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), len(lines)]


def test_concentration_finds_the_core(spark):
    """Two correlated statistics, in one of two pools with a fifth of the rows far off."""
    maker = np.random.default_rng(3)
    core = maker.multivariate_normal([5, -2], [[1, 0.8], [0.8, 1]], 400)
    x = np.vstack([core, maker.normal([9, 6], 0.3, (100, 2))])
    rows = [("clean", float(a), float(b)) for a, b in core] + [("mixed", float(a), float(b)) for a, b in x]
    found = outliers.fit(spark.createDataFrame(rows, "pool string, f0 double, f1 double"), [0.01, 0.01])
    made = {r.pool: (np.array([r.m0, r.m1]), np.array([[r.p0_0, r.p0_1], [r.p0_1, r.p1_1]])) for r in found.collect()}
    assert np.allclose(made["clean"][0], [5, -2], atol=0.2)
    assert np.allclose(np.linalg.inv(made["clean"][1]), np.cov(core.T), atol=0.35)
    mean, precision = made["mixed"]
    assert np.allclose(mean, core.mean(axis=0), atol=0.2)
    off = x - mean
    distance = np.einsum("ij,jk,ik->i", off, precision, off)
    limit = outliers.chi2_quantile(0.999, 2)
    assert (distance[400:] > limit).all() and (distance[:400] > limit).mean() < 0.02
    assert math.isclose(outliers.chi2_quantile(0.95, 2), 5.991, abs_tol=0.01)


def test_outliers_follow_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op1_robust_outliers(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id").collect()
    good = [r for r in found if r.quality == 1 and not r.base_failed]
    bad = [r for r in found if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(r.kept for r in bad) <= 0.3 * len(bad)


def plain_spans(text):
    pattern = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    found = [(m.start(), 0, m.end()) for m in pattern.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_secret_base_spans(spark, texts):
    kinds = secrets.KINDS
    for r in queries.op3_secret_scan(spark, SF).collect():
        base = plain_spans(texts[r.doc_id])
        joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_assignments_are_those_of_the_pattern():
    for text in ("Token==abcdefgh1", "API_KEY: 'x' secret=secret=password=12345678", "toKen=abcdefgh", "İpasswd = \"abcdefgh-\"", "token:short"):
        assert secrets.assigned(text) == [(a, b) for a, k, b in plain_spans(text) if k == 0]


def test_window_entropy_is_shannons():
    word = "aB3dE5gH7jK9mN1pQrStUvWxYz000000000000000000aaaaaaaaaaaaaaaaaaaa"

    def entropy(part):
        return -sum(n / len(part) * math.log2(n / len(part)) for n in Counter(part).values())

    hot = [i for i in range(len(word) - 19) if entropy(word[i : i + 20]) >= 3.5 and re.search("[a-z]", word[i : i + 20], re.I) and re.search("[0-9]", word[i : i + 20])]
    covered = sorted({j for i in hot for j in range(i, i + 20)})
    assert [j for a, b in secrets.hot_windows(word, 3.5) for j in range(a, b)] == covered


def test_entropy_adds_tokens_and_leaves_plain_text():
    token = "xK9vQ2mZ7pLw4TbN8cRy"
    assert secrets.find_spans(f"see {token} now") == [(4, 3, 4 + len(token))]
    for clean in ("antidisestablishmentarianism", "a/path/to/some-file-name/2024/01/02", "550e8400-e29b-41d4-a716-446655440000", "01234567890123456789", "sha256: 9F86D081884C7D659A2FEAA0"):
        assert secrets.find_spans(clean) == []


def test_ridge_is_the_plain_solution(spark):
    maker = np.random.default_rng(1)
    x = maker.normal(size=(300, 10))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.8).astype(float)
    features = quality.Features(x.mean(axis=0), x.std(axis=0), count=40)
    rows = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], ", ".join([*(f"f{i} double" for i in range(10)), "label double"]))
    z, penalty = features(x), np.eye(41)
    penalty[-1, -1] = 1e-9
    assert np.allclose(quality.solve(rows.repartition(5), features), np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)


def test_fourier_features_give_the_gaussian_kernel():
    maker = np.random.default_rng(2)
    x = maker.normal(size=(20, 4))
    z = quality.Features(np.zeros(4), np.ones(4), count=20_000, width=2.0)(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * 2.0**2))
    assert np.abs(z @ z.T - exact).max() < 0.05


def test_pooled_steps_rise():
    blocks = pool_violators(np.ones(6), np.array([0.1, 0.5, 0.3, 0.3, 0.9, 0.8]), np.arange(6.0))
    assert [round(b[1], 3) for b in blocks] == [0.1, 0.367, 0.85]


def test_quality_on_held_out_labels(spark):
    found = queries.op6_quality_classifier(spark, "/root/testdata/sf0.01")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.filter("held_out").join(marks, "doc_id").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) >= 0.93 * len(rows)


def test_matching_is_that_of_word_by_word_search():
    lexicon = toxicity.known_entries() | {" bad": 2.0, " badge ": 1.0}
    matcher = toxicity.Matcher(lexicon)
    for text in ("You 1d10t!! a trash can, sore loser", "badge badly bad", "іdіоt ѕtupіd", "STÜPID st@pid$ l0ser", "", "trash can trash"):
        folded = toxicity.fold(text)
        words, total = folded.split(), 0.0
        plain = f" {' '.join(words)} "
        for phrase in toxicity.EXCEPTIONS:
            plain = plain.replace(toxicity.fold(phrase), "  ")
        for word in plain.split():
            total += max([w for e, w in lexicon.items() if f" {word} ".startswith(e)], default=0.0)
        assert math.isclose(matcher.rate(folded), total / math.sqrt(folded.count(" ")) if total else 0.0)


def test_toxicity_on_held_out_labels(spark):
    found = queries.op7_toxicity(spark, "/root/testdata/sf0.1")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.filter("held_out").join(marks, "doc_id").collect()
    caught = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in caught) >= 0.9 * len(caught)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op8_language_id(spark, sf).filter("held_out").join(queries.table(spark, sf, "documents"), "doc_id")
    rows = found.collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)


def test_gram_vectors_are_plain_counts():
    counts, letters = language.gram_counts(["ab, AB", None, "12"])
    assert letters.tolist() == [4, 0, 0]
    assert counts[0].sum() == 2 * (3 + 2) and set(counts[0]) <= {0.0, 2.0, 4.0} and not counts[1:].any()


def test_labeller_slopes():
    model = BlockLabeller(5, 3, 1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    maker = np.random.default_rng(0)
    x, lengths, y = maker.normal(size=(4, 2, 5)), np.array([4, 2]), (maker.random((4, 2)) > 0.5).astype(float)
    _, slopes = model.slopes(x, lengths, y)
    for name, slope in slopes.items():
        at = tuple(maker.integers(s) for s in slope.shape)
        high, low = (model_loss(model, name, at, step, x, lengths, y) for step in (1e-5, -1e-5))
        assert math.isclose((high - low) / 2e-5, slope[at], rel_tol=1e-4, abs_tol=1e-7)


def model_loss(model, name, at, step, x, lengths, y):
    model.weights[name][at] += step
    loss = model.slopes(x, lengths, y)[0]
    model.weights[name][at] -= step
    return loss


def test_main_text_of_every_page(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op10_html_extraction(spark, SF).collect():
        page = pages[r.page_id]
        inner = page[page.index("<article>") + 9 :]
        inner = re.split("</article>|<footer", inner)[0]
        plain = " ".join(decode(re.sub(r"<[^>]*>", " ", inner)).split())
        assert " ".join(r.text.split()) == plain and r.n_chars == len(r.text)


def decode(text):
    for name, sign in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&amp;", "&")):
        text = text.replace(name, sign)
    return text


def test_blocks_of_a_page():
    page = "<p>A<br>b &amp;\n c<p>d <b>e</b><script>x<p>y</script><div>f<ul><li>g<li>h</ul></div><!-- i -->j<a href='>'>k</a> 1 < 2"
    assert [b.text for b in html.read_blocks(page)] == ["A b & c", "d e", "f", "g", "h", "jk 1 < 2"]


def links_of(texts, percent=85):
    sets = {}
    for name, text in texts.items():
        words = PLAIN.findall(text.translate({c: c + 32 for c in range(65, 91)}))
        sets[name] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    names = sorted(sets)
    return {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}


def test_near_copies_in_a_chain(spark):
    """Copies with ever more words changed: ends are no links, the chain is one component."""
    words = [f"w{i}" for i in range(400)]
    rows = []
    for step in range(40):
        rows.append((step, " ".join(words)))
        words[step * 10] = f"changed{step}"
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(frame).collect()
    links = links_of(dict(rows))
    assert (0, 39) not in links and all((i, i + 1) in links for i in range(39))
    assert {r.component_id for r in found} == {0}


def test_nothing_rests_on_the_pivots(spark, monkeypatch):
    """Tiles of two rows; many copies of one text, each changed on its own."""
    monkeypatch.setattr(near_dedup, "TILE", 2)
    maker = np.random.default_rng(5)
    rows = []
    for i in range(60):
        words = [f"w{j}" for j in range(150)]
        for at in maker.choice(150, int(maker.integers(0, 7)), replace=False):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    root = {i: i for i, _ in rows}
    links = links_of(dict(rows))
    for _ in rows:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert {r.doc_id: r.component_id for r in found} == root


def test_sketch_limit_lets_similar_sets_through():
    maker = np.random.default_rng(9)
    for size in (20, 150, 500, 2000):
        for _ in range(40):
            shared = maker.integers(0, 2**64, int(size * 0.92), dtype=np.uint64)
            a, b = (np.unique(np.concatenate([shared, maker.integers(0, 2**64, size - len(shared), dtype=np.uint64)])) for _ in "ab")
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                flipped = np.bitwise_count(near_dedup.odd_sketch(a) ^ near_dedup.odd_sketch(b)).sum()
                assert near_dedup.could_be_similar(len(a), len(b), flipped)
        far = near_dedup.odd_sketch(maker.integers(0, 2**64, size, dtype=np.uint64))
        assert not near_dedup.could_be_similar(size, size, np.bitwise_count(far ^ near_dedup.odd_sketch(a)).sum())


def test_parts_of_a_benchmark_find_the_same(docs, benchmark):
    whole = sorted(map(repr, decontaminate.contamination(docs, benchmark).collect()))
    parts = sorted(map(repr, decontaminate.contamination(docs, benchmark, part_windows=400).collect()))
    assert whole == parts


def test_every_stage_keeps_what_it_should(spark, docs, benchmark, texts):
    """Each stage of the pipeline against its rule, on the rows it got."""
    folder = SF
    first = corpus_pipeline.known_language(spark, docs, folder)
    lettered = {i for i, t in texts.items() if any(c.isalpha() for c in t)}
    assert {r.doc_id for r in first.collect()} == lettered
    second = corpus_pipeline.one_of_near_copies(spark, docs, folder).collect()
    root = {i: i for i in texts}
    links = links_of(texts, 80)
    for _ in range(20):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert sorted(r.doc_id for r in second) == sorted(i for i, r in root.items() if i == r)
    hit = {r.doc_id for r in decontaminate.contamination(docs, benchmark).filter("contaminated").collect()}
    third = corpus_pipeline.without_benchmark(spark, docs, folder).collect()
    assert hit and {r.doc_id for r in third} == set(texts) - hit
    for r in corpus_pipeline.masked_secrets(spark, docs, folder).collect():
        spans = plain_spans(texts[r.doc_id])
        assert (r.text == texts[r.doc_id]) or spans or secrets.find_spans(texts[r.doc_id])
        assert not [s for s in plain_spans(r.text) if s[1] != 0] and r.n_chars == len(r.text)
    last = corpus_pipeline.mixed_sources(spark, docs, folder).groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t"))
    assert all(abs(r.n - r.t) <= 1 for r in last.collect())
