"""Pivot index, packing, mixing, extraction, sharding, classifier, components and the pipeline."""

import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blobtally.llm import bayes_quality as bq
from blobtally.llm import bestfit_packing as bp
from blobtally.llm import label_sharding as ls
from blobtally.llm import pivot_index as pi
from blobtally.llm import temperature_mixing as tm
from blobtally.llm import text_density as td
from blobtally.llm.common import Forest, components

ODD = [(None, "no id here"), (3, None), (4, ""), (5, " \t\n "), (6, "one"), (6, "one"), (7, "é ü x", None, None),
       (8, "word " * 5000, "en", "big")]


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + \
        [(int(a), int(b)) for a, b in rng.integers(200, 400, (120, 2))] + [(7, 7), (500, 501), (501, 500)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    f = Forest(600)
    f.join(np.array([e[0] for e in edges]), np.array([e[1] for e in edges]))
    want = {x: int(f.label[x]) for a, b in edges if a != b for x in (a, b)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(pi, "BLOCK", 64)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(500, 32))
    near = v[:150] + 0.08 * rng.normal(size=(150, 32))
    hot = v[0] + 0.05 * rng.normal(size=(200, 32))
    rows = [(i, [float(y) for y in x]) for i, x in enumerate(np.concatenate([v, near, hot, v[:5], 3 * v[5:8]]))]
    bad = [(9000, None), (9001, []), (9002, [0.0] * 32), (9003, [float("nan")] * 32), (9004, [1.0, None] * 16),
           (9005, [float("inf")] + [0.0] * 31), (9003, [float("nan")] * 32), (None, rows[3][1]), (9006, [1.0, 2.0])]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                           T.StructField("label", T.IntegerType())])
    out = pi.near_vectors(spark.createDataFrame([(*r, 1) for r in rows + bad], schema)).collect()
    assert len(out) == len(rows) + len(bad)
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1)[:, None]
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    want = link.sum(1)
    want += link[3] | (np.arange(len(u)) == 3)  # the row without an id equals row 3
    got = {r["vec_id"]: r for r in out}
    n = np.array([got[i]["n_links"] for i in range(len(u))])
    assert (n <= want).all() and n.sum() >= 0.99 * want.sum()
    f = Forest(len(u))
    f.join(*np.nonzero(link))
    assert np.mean([got[i]["component_id"] == f.label[i] for i in range(len(u))]) > 0.99
    assert all(r["n_links"] == 0 and r["kept"] and r["component_id"] == r["vec_id"] for r in out if (r["vec_id"] or 0) >= 9000)
    assert not got[None]["kept"]
    assert pi.near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_candidates_are_counted_postings():
    """Both ways of counting give the pairs that share enough pivots, each once over all lists."""
    rng = np.random.default_rng(6)
    for n, pool in ((60, 200), (60, 14)):  # few and many shared pivots
        sig = np.array([rng.permutation(pool)[:12] for _ in range(n)], np.int32)
        shared = np.array([[len(set(x) & set(y)) for y in sig.tolist()] for x in sig.tolist()])
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if shared[i, j] >= 2}
        for blocks in (1, 2):
            got = Counter()
            for pivot in range(pool):
                rows = np.flatnonzero((sig == pivot).any(axis=1))
                half = [rows[rows % blocks == k] for k in range(blocks)]
                for p in range(blocks):
                    for q in range(p, blocks):
                        for x, y in pi.candidates(sig, half[p], half[q], p == q, pivot, 2):
                            got.update((min(i, j), max(i, j)) for i, j in zip(x.tolist(), y.tolist()))
            assert set(got) == want and set(got.values()) <= {1}


def test_links_close_to_the_threshold(spark):
    """Pairs at 0.90 to 0.92, and no link below: recall against all pairs."""
    rng = np.random.default_rng(9)
    v = rng.normal(size=(600, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    other = rng.normal(size=(600, 64))
    other -= (other * v).sum(1)[:, None] * v
    other /= np.linalg.norm(other, axis=1)[:, None]
    c = rng.uniform(0.88, 0.92, 600)[:, None]
    every = np.concatenate([v, c * v + np.sqrt(1 - c * c) * other])
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(every)], "vec_id long, embedding array<double>")
    u = np.array([[float(y) for y in x] for x in every])
    u /= np.linalg.norm(u, axis=1)[:, None]
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    got = np.array([r["n_links"] for r in sorted(pi.near_vectors(df).collect(), key=lambda r: r["vec_id"])])
    assert 500 < link.sum() and (got <= link.sum(1)).all() and got.sum() >= 0.98 * link.sum()


def test_pivots_come_without_a_single_task(spark):
    rows = spark.range(3000).select(F.array(F.rand(1), F.rand(2), F.rand(3)).alias("v"), F.xxhash64("id").alias("k1"), F.xxhash64(F.lit(1), "id").alias("k2"))
    assert len(pi.choose_pivots(rows, 3000)[3]) > 2
    plan = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and pi.choose_pivots(rows.limit(0), 0) == {}


def test_packing(make_docs, prose):
    rows = ODD + [(100 + i, prose(i % 70, 5 + 13 * (i % 40)), "en", f"s{min(i % 9, 3)}") for i in range(300)]
    docs = make_docs(rows, extra=["shard", "cluster", "copy"])
    out = bp.pack(docs, capacity=512, quota=3, shard_words=20_000, carry=["doc_id", "source", "text"]).collect()
    n = {}
    bins = defaultdict(list)
    for r in out:
        n.setdefault((r["doc_id"], r["text"]), []).append(r["n_words"])
        if r["bin"] >= 0:
            bins[r["shard"], r["bin"]].append(r)
        else:
            assert r["n_words"] == 0
    copies = Counter((i, t) for i, t, *_ in rows)
    assert all(sum(v) == len((k[1] or "").split()) * copies[k] for k, v in n.items()) and set(n) == set(copies)
    for b in bins.values():
        b.sort(key=lambda r: r["offset"])
        assert all(x["offset"] + x["n_words"] == y["offset"] for x, y in zip(b, b[1:]))
        assert b[0]["offset"] == 0 and b[-1]["offset"] + b[-1]["n_words"] <= 512
        assert max(Counter(r["source"] for r in b).values()) <= 3
        assert max(Counter(" ".join(r["text"].lower().split()) for r in b).values()) == 1
    assert bp.pack(docs.limit(0)).count() == 0


def test_bins_take_the_tightest_compatible():
    rng = np.random.default_rng(1)
    bins = bp.Bins(100, 2)
    for _ in range(400):
        need, source, cluster = int(rng.integers(1, 60)), int(rng.integers(0, 4)), int(rng.integers(0, 60))
        fits = [r for r, c, k in zip(bins.room, bins.counts, bins.clusters) if r >= need and c.get(source, 0) < 2 and cluster not in k]
        before = list(bins.room)
        b, _ = bins.place(need, source, cluster)
        assert (before[b] == min(fits)) if fits else b == len(before)


def test_mixture(make_docs, prose, monkeypatch):
    monkeypatch.setattr(tm, "BUCKET_ROWS", 20)
    rows = ODD + [(100 + i, prose(i, 20 + i % 30), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(400)]
    docs = make_docs(rows, extra=["epoch", "first", "bucket"])
    out = tm.mixture(docs, target_flattening=0.8, carry=["doc_id", "source", "text"]).collect()
    sizes, used = Counter(), Counter()
    for i, t, *rest in rows:
        sizes[rest[1] if len(rest) > 1 else "s"] += len((t or "").split())
    for r in out:
        used[r["source"]] += r["n_tokens"]
    total = sum(sizes.values())
    sources = docs.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), r"\s+"))).alias("size"))
    sources = docs.sparkSession.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    a = tm.solve_exponent(sources, 0.8)
    p = np.array([v / total for v in sizes.values() if v])
    w = p ** a / (p ** a).sum()
    h = lambda q: -(q * np.log(q)).sum()
    flat = h(p) + 0.8 * (np.log(len(p)) - h(p))
    assert 0 <= a <= 1 and (abs(h(w) - flat) < 1e-6 or (w * total / np.array([v for v in sizes.values() if v])).max() <= tm.MAX_REPEATS + 1e-6)
    for (s, size), weight in zip(((s, v) for s, v in sizes.items() if v), w):
        longest = max(len((t or "").split()) for i, t, *r in rows if (r[1] if len(r) > 1 else "s") == s)
        assert weight * total <= used[s] + 1e-6 and used[s] <= weight * total + longest
    times = Counter((r["doc_id"], r["text"], r["epoch"]) for r in out)
    have = Counter((i, t) for i, t, *_ in rows)
    assert all(n <= have[k[:2]] for k, n in times.items())
    assert tm.mix(docs).columns == docs.columns and tm.mixture(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="repeats"):
        tm.mixture(docs, budget=10.0 * total)
    # Blocks and cuts are those of the exact running sums in the order of each pass.
    for s in {r["source"] for r in out}:
        for e in {r["epoch"] for r in out if r["source"] == s}:
            part = sorted((r for r in out if r["source"] == s and r["epoch"] == e and r["n_tokens"]), key=lambda r: r["place"])
            assert [r["block"] for r in part] == sorted(r["block"] for r in part)
            first = [e * sizes[s] + sum(x["n_tokens"] for x in part[:k]) for k in range(len(part))]
            whole = dict(zip((s_ for s_, v in sizes.items() if v), w * total))[s]
            assert all(min(int(f / whole * 100), 99) == r["block"] for f, r in zip(first, part))


def test_extract(spark):
    long_ = "Plain text of some length, with a few more words. " * 8
    page = (f'<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><header><h1>Site</h1></header>'
            f'<nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies, please accept all of them today.</div>'
            f'<div class="wrap"><article><h1>Title &amp; more</h1><p>{long_}<p>Second\n  <b>bold</b> par.<br>Line'
            f'<ul><li>one<li>two</ul><!-- gone --><form>Sign up</form></article><aside>Side text that is long enough.</aside>'
            f'<section id="comments"><p>{long_}{long_}</p></section></div><footer>&copy; foot</footer>')
    want = f"Title & more {long_.strip()} Second bold par. Line one two"
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (3, "u", ""), (4, "u", "just text < more"), (None, None, "<p>x"),
            (5, "u", "<div>" * 20000 + "deep" + "&#233;"), (6, "u", "<" * 5000), (7, "u", "<p>" + "long word " * 50000)]
    out = {(r["page_id"]): r for r in td.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[1]["text"] == want and out[1]["n_chars"] == len(want)
    assert out[2]["text"] == out[3]["text"] == "" and out[4]["text"] == "just text < more" and out[None]["text"] == "x"
    assert out[5]["text"] == "deepé" and out[7]["n_chars"] == 499_999
    assert td.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_broken_markup_takes_time_in_proportion():
    n = 100_000
    for page in ("<b>" * n + "</i>" * n + "<p>end", "<div class=ad>" * n + "<ul>" * n + "end", "<p><button>" + "<ul>" * n + "<li>" * n + "end"):
        began = time.monotonic()
        td.main_text(page)
        assert time.monotonic() - began < 30


def test_extract_takes_the_article_of_every_page(spark, sf_dir):
    import html
    import re
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for r in pages.join(td.extract(pages).drop("url"), "page_id").collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        assert r["text"] == re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", inside))).strip()


def test_article_is_found_without_its_tag(spark):
    import html
    import re
    right = {"div": 0, "bare": 0}
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        want = re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", inside))).strip()
        page = re.sub(r"<(/?)article\b", r"<\1div", r["html"])
        right["div"] += td.main_text(page) == want
        right["bare"] += td.main_text(re.sub(r"""\s(class|id|role)\s*=\s*("[^"]*"|'[^']*')""", "", page)) == want
    assert right["div"] >= 0.99 * len(rows) and right["bare"] >= 0.98 * len(rows)


def test_unmarked_sidebars_go(prose):
    paragraphs = [prose(i, 60) for i in range(8)]
    body = "".join(f"<p>{x}</p>" for x in paragraphs[:5])
    rest = "".join(f"<p>{x}</p>" for x in paragraphs[5:])
    side = "".join(f"<p>Tip {i}</p><p>Buy now</p>" for i in range(6))
    page = f"<html><body><div><div><h1>Title</h1><div>{body}</div><div>{rest}</div><div>{side}</div></div><div>{side}</div></div></body></html>"
    assert td.main_text(page) == " ".join(["Title", *paragraphs])


def test_article_keeps_figures_and_slugs(prose):
    text = [prose(20 + i, 60) for i in range(6)]
    page = f"""<html><body><article><h1 id="social-history">Social history</h1><p>{text[0]}</p>
        <figure><table><tr><td>Cell one</td></tr></table><figcaption>Caption</figcaption></figure>
        <figure><blockquote><p>{text[1]}</p></blockquote></figure>
        <section id="related-work"><h2>Related work</h2><p class="share-price">{text[2]}</p></section>
        <div class="widget-theory"><p>{text[3]}</p><p>{text[4]}</p></div>
        <div class="share social"><a href="a">One</a> <a href="b">Two</a></div><p>{text[5]}</p></article></body></html>"""
    assert td.main_text(page) == " ".join(["Social history", text[0], "Cell one", "Caption", text[1], "Related work",
                                           text[2], text[3], text[4], text[5]])


def test_sharding(make_docs, prose, monkeypatch):
    monkeypatch.setattr(ls, "_PIECE_ROWS", 30)
    rows = ODD + [(100 + i, prose(i // 4 if i < 200 else 1000, 12)) for i in range(400)]
    docs = make_docs(rows, extra=["id", "grp", "shard"])
    out = ls.shard_documents(docs, 10).collect()
    counts = Counter(r["shard"] for r in out)
    assert len(out) == len(rows) and set(counts) == set(range(10)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(n))
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    assert {r["law"] for r in out} == {"rows"} and {r["grown_shard"] for r in out} == {None}
    where = {r["doc_id"]: r["shard"] for r in out}
    split = sum(len({where[100 + 4 * g + k] for k in range(4)}) > 1 for g in range(50))
    assert split <= 10  # only groups that the quotas or the last step parted
    assert ls.shard_documents(docs.limit(0), 10).count() == 0


def test_rounds_decide_the_shards(make_docs, prose, monkeypatch):
    """More rounds cut fewer groups, none hardly any chance; the same rows in other files go to the same shards."""
    rows = [(i, prose(i // 5 if i < 600 else i, 9)) for i in range(1500)]
    docs = make_docs(rows)

    def cut(out):
        where = {r["doc_id"]: r["shard"] for r in out}
        return sum(len({where[5 * g + k] for k in range(5)}) > 1 for g in range(120)), where

    found = {}
    for rounds in (0, 1, ls.ROUNDS):
        keyed = docs.select(F.md5("text").alias("grp"), F.xxhash64("doc_id", F.md5("text")).alias("who"), F.col("doc_id").alias("id"), "doc_id")
        out = ls.balanced_shards(keyed, 10, rounds).join(keyed.select("id", "doc_id"), "id").collect()
        n = Counter(r["shard"] for r in out)
        assert len(out) == 1500 and max(n.values()) - min(n.values()) <= 1
        found[rounds] = cut(out)[0]
    assert found[0] > 110 and found[1] < found[0] / 3 and found[ls.ROUNDS] <= min(found[1], 12), found
    # The last step moves only the rows above the even size.
    keyed = docs.select(F.md5("text").alias("grp"), F.xxhash64("doc_id", F.md5("text")).alias("who"), F.col("doc_id").alias("id"))
    labels = {r["id"]: r["shard"] for r in ls.propagate(keyed, 10).collect()}
    final = {r["id"]: r["shard"] for r in ls.balanced_shards(keyed, 10).collect()}
    n = Counter(labels.values())
    assert sum(labels[i] != final[i] for i in labels) == sum(max(0, v - 150) for v in n.values())
    where = [cut(ls.shard_documents(d, 10).collect())[1] for d in (docs.repartition(3), docs.repartition(7, "text"))]
    assert where[0] == where[1]


def test_classifier_on_held_out(make_docs, prose):
    rude = ["idiot", "moron", "trash"]
    rows, labels = list(ODD), [(None, 1, 0), (3, None, 1), (100, 1, 0)]
    for i in range(600):
        t, kind = prose(i, 120).split(), i % 4
        if kind == 1:
            t = [x.upper() + "!!" for x in t]
        if kind == 2:
            t[10], t[50], t[90] = rude[i % 3], rude[i // 3 % 3], rude[i // 9 % 3]
        rows.append((100 + i, " ".join(t), "en", f"s{i % 3}"))
        if i % 2 == 0 or i % 3:
            labels.append((100 + i, int(kind != 1), int(kind == 2)))
    docs = make_docs(rows, extra=["kept", "e"])
    held = {100 + i for i in range(600)} - {x[0] for x in labels}
    out = bq.classify(docs, docs.sparkSession.createDataFrame(labels, "doc_id long, quality int, toxic int"), carry=["doc_id", "e"]).collect()
    assert len(out) == len(rows) and out[0]["e"] == "mine"
    right = [r["kept"] == ((r["doc_id"] - 100) % 4 in (0, 3)) for r in out if r["doc_id"] in held]
    assert len(right) > 50 and np.mean(right) > 0.95
    none = docs.sparkSession.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r["kept"] for r in bq.classify(docs, none).collect())
    assert bq.classify(docs.limit(0), none).count() == 0


def test_site_priors_shrink(spark):
    counts = spark.createDataFrame([("a", "x", 1000, 900, 0), ("a", "y", 0, 0, 0), ("b", "x", 1000, 100, 500), ("c", "x", 1, 0, 1)],
                                   "source string, lang string, n long, good long, toxic long")
    p = {(r[0], r[1]): r for r in bq.site_priors(counts).collect()}
    assert abs(p["a", "x"]["good_prior"] - 0.9) < 0.02 and abs(p["a", "y"]["good_prior"] - 0.9) < 0.02
    assert 0.05 < p["c", "x"]["good_prior"] < 0.5  # one row says little


def test_pipeline_stages(spark, make_docs, prose, tmp_path):
    import corpus_pipeline as cp
    from blobtally.llm.common import materialise
    shared = prose(999, 70)
    rows = ODD + [(100 + i, prose(i, 120) + " " + (shared if i % 5 == 0 else ""), "en", f"s{i % 3}") for i in range(60)]
    rows += [(300 + i, rows[20 + i][1]) for i in range(10)] + [(400, prose(1, 90).upper())]
    docs = make_docs(rows, extra=["kept", "uid"])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    seen, at = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "simhash_near_dedup", "substring_dedup", "source_mixing", "best_fit_packing"]
    for name, f in cp.STAGES:
        at = materialise(f(spark, at, str(tmp_path)), name)
        if name != "best_fit_packing":
            assert at.columns == docs.columns
        seen[name] = {r["doc_id"] for r in at.select("doc_id").collect()}
    assert seen["quality_rules"] == set(range(100, 160)) | set(range(300, 310))
    assert seen["simhash_near_dedup"] == set(range(100, 160))
    assert seen["substring_dedup"] == set(range(100, 160))
    assert seen["best_fit_packing"] == seen["source_mixing"] and cp.run(spark, str(tmp_path)).count() > 0
